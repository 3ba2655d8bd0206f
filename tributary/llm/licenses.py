"""License scans: exact phrases, and short notices with a bounded number of edits.

A text is searched as its lower-cased words joined by single spaces.  A notice
with at most k edits is split into k + 1 pieces, so at least one piece occurs
unchanged and moved by at most k characters; one Aho-Corasick pass finds all
pieces of all notices.  From the words with which such a notice can start (and
whose letters keep enough of its grams) the regex library's bounded-error match
verifies the runs of whole words and counts their edits.  Every run within k
edits is seen; of runs of a notice that share a word the best one is a match.
Base phrases are found exactly, wherever their words stand consecutively.
Every text is scanned whole, in the task that read it.

Defined cases: null and empty texts have no words and no matches; overlapping
places of a base phrase count each; repeated rows are scanned row by row;
extra columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .suffix_arrays import spread
from .textmap import alnum_words, map_texts

# The base phrases and their labels.
BASE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


@dataclass(frozen=True)
class Notice:
    """A short notice (normalised words) that may occur with up to ``edits`` edits."""

    label: str
    text: str
    edits: int

    @property
    def pieces(self) -> list[tuple[int, str]]:
        """(offset, piece): k + 1 contiguous pieces that cover the notice."""
        n, k = len(self.text), self.edits + 1
        cuts = [n * i // k for i in range(k + 1)]
        return [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


# Wordings of well-known licences.
NOTICES = (
    Notice("gpl", "gnu general public license", 3),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("apache", "apache license", 1),
    Notice("apache", "licensed under the apache license version 2 0", 5),
    Notice("mit", "mit license", 1),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 8),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", 8),
    Notice("cc-by", "creative commons attribution", 2),
    Notice("mpl", "mozilla public license", 2),
)

_RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.ArrayType(T.StringType())),
    T.StructField("labels", T.ArrayType(T.StringType())), T.StructField("score", T.DoubleType()),
    T.StructField("matches", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()), T.StructField("edits", T.LongType())]))),
])
_MATCHES = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                               ("edits", pa.int64())]))


#: Letters of the grams that are counted before a match is tried.
GRAM = 3


class Scanner:
    """The automaton over all pieces, and a bounded-error pattern per notice."""

    def __init__(self, notices: tuple[Notice, ...] = NOTICES) -> None:
        import ahocorasick
        self.notices = notices
        self.seeds = ahocorasick.Automaton()
        of_piece: dict[str, list[tuple[int, int]]] = {}
        for n, notice in enumerate(notices):
            for offset, piece in notice.pieces:
                of_piece.setdefault(piece, []).append((n, offset))
        for piece, places in of_piece.items():
            self.seeds.add_word(piece, (len(piece), places))
        self.seeds.make_automaton()
        self.grams = [np.unique(gram_codes(notice.text)) for notice in notices]
        self.patterns = [regex.compile(f"(?:{regex.escape(notice.text, literal_spaces=True)}){{e<={notice.edits}}}",
                                       regex.BESTMATCH) for notice in notices]
        self.edits = lru_cache(1 << 16)(self._edits)

    def _edits(self, n: int, run: str) -> int | None:
        """Edits between a run of words and a notice, None beyond its number."""
        match = self.patterns[n].fullmatch(run)
        return sum(match.fuzzy_counts) if match else None

    def places(self, text: str) -> Iterator[tuple[int, list[int]]]:
        """(notice, words): the words with which an occurrence can start.

        One piece is kept and has moved by at most as many characters as there
        are edits.  An edit touches at most ``GRAM`` grams, so an occurrence
        also keeps all but ``GRAM`` times the edits of the notice's grams.
        """
        around: dict[int, list[int]] = {}
        for last, (size, places) in self.seeds.iter(text):
            for n, offset in places:
                around.setdefault(n, []).append(last + 1 - size - offset)
        if not around:
            return
        starts, codes = np.array(word_starts(text)), gram_codes(text)
        for n, found in around.items():
            size, k = len(self.notices[n].text), self.notices[n].edits
            at = np.unique(found)
            low, high = np.searchsorted(starts, at - k), np.searchsorted(starts, at + k, "right")
            words = np.unique(spread(low, high - low))
            known = np.concatenate([[0], np.cumsum(np.isin(codes, self.grams[n]))])
            begin = np.minimum(starts[words], len(codes))
            kept = known[np.minimum(begin + size + k - GRAM + 1, len(codes))] - known[begin]
            yield n, words[kept >= size - GRAM + 1 - GRAM * k].tolist()

    def occurrences(self, n: int, text: str, starts: list[int], words: Iterable[int]) -> Iterator[tuple[int, int, int]]:
        """(edits, first, last word) of all runs of whole words that begin with
        one of ``words`` and are the notice with at most its number of edits."""
        size, k = len(self.notices[n].text), self.notices[n].edits
        ends = [*(s - 1 for s in starts[1:]), len(text)]
        for w in words:
            low, high = bisect_left(ends, starts[w] + size - k), bisect_right(ends, starts[w] + size + k)
            for last in range(max(low, w), high):
                edits = self.edits(n, text[starts[w]:ends[last]])
                if edits is not None:
                    yield edits, w, last

    def near_matches(self, text: str) -> list[dict]:
        """Matches: label, first and last word, edits.  Of occurrences of a
        notice that share a word, the one with fewest edits stays, then the
        first, then the shortest."""
        found, starts = {}, None
        for n, words in self.places(text):
            starts = starts or word_starts(text)
            label, size = self.notices[n].label, len(self.notices[n].text)
            taken: set[int] = set()
            for edits, first, last in sorted(self.occurrences(n, text, starts, words)):
                if taken.isdisjoint(range(first, last + 1)):
                    taken.update(range(first, last + 1))
                    key = (first, last, label)
                    found[key] = min(found.get(key, (edits, size)), (edits, size))
        return [{"label": label, "first_word": first, "last_word": last, "edits": edits, "length": length}
                for (first, last, label), (edits, length) in sorted(found.items())]


def gram_codes(text: str) -> np.ndarray:
    """The grams of a text as numbers (a code point has 21 bits)."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    return points[:-2] << 42 | points[1:-1] << 21 | points[2:] if len(points) >= GRAM else points[:0]


def word_starts(text: str) -> list[int]:
    """Where the words of a text joined by single spaces begin."""
    return [0, *(m.end() for m in re.finditer(" ", text))]


def base_places(joined: str) -> list[tuple[int, str]]:
    """(word, label) of every place of a base phrase in " word word ... "."""
    places = []
    for phrase, label in BASE_PHRASES.items():
        at = joined.find(f" {phrase} ")
        while at >= 0:
            places.append((joined.count(" ", 0, at), label))
            at = joined.find(f" {phrase} ", at + 1)
    return places


def scan_text(text: bytes | None, scanner: Scanner) -> tuple:
    words = alnum_words(text)
    joined = b" ".join(words).decode()
    base = base_places(f" {joined} ") if words else []
    near = scanner.near_matches(joined)
    starts = [w for w, _ in base]
    base_labels = {label for _, label in base}
    score = 1.0 if base else max((1 - m["edits"] / m["length"] for m in near), default=0.0)
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), sorted(base_labels),
            sorted(base_labels | {m["label"] for m in near}), score,
            [{k: m[k] for k in ("label", "first_word", "last_word", "edits")} for m in near])


def scan(docs: DataFrame, text: str = "text", keep: list | None = None,
         notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """``row`` (the kept columns) and ``res``: n_words, the base places (count,
    first and last word, labels), all labels, a score, and the near matches."""
    types = [pa.int64()] * 4 + [pa.list_(pa.string())] * 2 + [pa.float64(), _MATCHES]

    def kernel():
        scanner = Scanner(notices)

        def run(texts):
            found = [scan_text(t, scanner) for t in texts]
            return [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
        return run
    return map_texts(docs, text, kernel, _RESULT, keep=keep)
