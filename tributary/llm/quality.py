"""Quality by weak supervision: rules vote or abstain, EM weighs the votes.

Each rule looks at a few counts of the whole text and votes bad (-1), good
(+1) or abstains (0).  Spark counts the vote patterns (twelve rules with two
outcomes each: at most 4,096 rows reach the driver, whatever the corpus);
expectation-maximisation on those counts estimates how often each rule votes
how on good and on bad documents; the posterior probability of good decides,
not the strictest rule.  A base rule drops very short and very repetitive
texts whatever the posterior is.

Defined cases: a null text has no words and fails the base rule, as does an
empty one; ties and repeated rows are judged row by row; an empty table gives
no rows and the model its prior; extra columns pass through untouched.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textmap import map_texts, space_words

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_distinct", "n_lines", "n_letters", "n_upper", "n_exclaim", "n_stops", "n_stutter")
_RESULT = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])

REPEAT_WINDOW = 5
_UPPER = bytes(range(65, 91))
_NOT_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())
_CONTINUATION = bytes(range(128, 192))
_SPACES = b" \t\n\x0b\x0c\r"


def count_text(text: bytes | None) -> list[int]:
    """The counts of one text, in the order of ``COUNTS``."""
    text = text or b""
    words = space_words(text)
    lines = [line for line in text.split(b"\n") if line.strip()]
    codepoints = text.translate(None, _CONTINUATION)
    letters = codepoints.translate(None, _NOT_LETTERS)
    grams = list(zip(*(words[k:] for k in range(REPEAT_WINDOW)), strict=False))
    repeated = 0
    if len(set(grams)) < len(grams):
        times = Counter(grams)
        covered_to = 0
        for i, gram in enumerate(grams):
            if times[gram] > 1:
                repeated += i + REPEAT_WINDOW - max(i, covered_to)
                covered_to = i + REPEAT_WINDOW
    return [len(words), len(codepoints.translate(None, _SPACES)),
            len(text) - len(text.translate(None, b"#*$%&|<>")), len(lines) - len(set(lines)), repeated,
            len(set(words)), len(lines), len(letters), len(letters) - len(letters.translate(None, _UPPER)),
            text.count(b"!"), text.count(b".") + text.count(b"?"), sum(map(eq, words, words[1:]))]


def with_counts(docs: DataFrame, text: str = "text", keep: list | None = None) -> DataFrame:
    """``row`` (the kept columns) and ``res`` (the counts) per document."""
    def kernel():
        def run(texts):
            columns = np.array([count_text(t) for t in texts], np.int64).reshape(len(texts), len(COUNTS))
            return [pa.array(c) for c in columns.T]
        return run
    return map_texts(docs, text, kernel, _RESULT, keep=keep)


def _share(c: Column, part: str, whole: str) -> Column:
    return c[part] / F.greatest(c[whole], F.lit(1))


def _rules() -> dict[str, Callable[[Column], Column]]:
    """Detectors vote bad or abstain; ``prose`` and ``varied`` vote good or abstain."""
    def bad(test):
        return lambda c: F.when(test(c), -1).otherwise(0)

    def good(test):
        return lambda c: F.when(test(c), 1).otherwise(0)

    def at_least(part, whole, limit):
        return bad(lambda c: _share(c, part, whole) >= limit)

    def prose(c):
        return ((_share(c, "n_letters", "word_chars") >= 0.9) & (_share(c, "n_symbols", "n_words") <= 0.02)
                & _share(c, "n_stops", "n_words").between(0.02, 0.5))

    def varied(c):
        return (_share(c, "n_repeat_words", "n_words") <= 0.05) & (_share(c, "n_distinct", "n_words") >= 0.3)

    return {
        "symbols": at_least("n_symbols", "n_words", 0.1),
        "repeats": at_least("n_repeat_words", "n_words", 0.25),
        "lines": bad(lambda c: (_share(c, "n_dup_lines", "n_lines") >= 0.3) & (c["n_lines"] >= 5)),
        "capitals": at_least("n_upper", "n_letters", 0.4),
        "shouting": at_least("n_exclaim", "n_words", 0.3),
        "stutter": at_least("n_stutter", "n_words", 0.25),
        "monotony": bad(lambda c: (_share(c, "n_distinct", "n_words") < 0.25) & (c["n_words"] < 2000)),
        "word_length": bad(lambda c: ~_share(c, "word_chars", "n_words").between(2.0, 12.0)),
        "letters": bad(lambda c: (_share(c, "n_letters", "word_chars") < 0.68) & (c["n_words"] >= 30)),
        "unpunctuated": bad(lambda c: (_share(c, "n_stops", "n_words") < 0.01) & (c["n_words"] >= 40)),
        "prose": good(prose),
        "varied": good(varied),
    }


RULES = _rules()


class VoteModel:
    """P(vote | good or bad) per rule and the share of good documents.

    ``log_odds[rule][vote + 1]`` is added to the prior for each vote.
    """

    def __init__(self, prior: float, votes: np.ndarray) -> None:
        self.prior = prior            # share of good documents
        self.votes = votes            # (class bad/good, rule, vote -1/0/1)
        self.log_odds = np.log(votes[1] / votes[0])

    @property
    def accuracies(self) -> np.ndarray:
        """Per rule: the probability that a vote it casts is right."""
        p = np.array([1 - self.prior, self.prior])
        right = p[0] * self.votes[0, :, 0] + p[1] * self.votes[1, :, 2]
        cast = sum(p[y] * (self.votes[y, :, 0] + self.votes[y, :, 2]) for y in (0, 1))
        return right / cast

    def probability(self, votes: list[Column]) -> Column:
        logit = F.lit(math.log(self.prior / (1 - self.prior)))
        for vote, (bad, none, good) in zip(votes, self.log_odds.tolist(), strict=True):
            logit = logit + F.when(vote < 0, bad).when(vote > 0, good).otherwise(none)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> VoteModel:
    """EM on vote patterns (n, rules) in -1/0/1 and how often each occurs.

    Starts from "one bad vote outweighs two good ones"; every estimate carries
    a small prior towards right votes, so that no rule turns around and an
    empty table gives a usable model.
    """
    n_rules = patterns.shape[1]
    total = max(float(counts.sum()), 1.0)
    towards = np.zeros((2, n_rules, 3))
    towards[0] = [0.3, 0.65, 0.05]
    towards[1] = [0.002, 0.3, 0.698]
    weight = np.array([0.02, 0.02]) * total + 1
    bad, good = (patterns < 0).sum(1), (patterns > 0).sum(1)
    p_good = np.where(2 * bad > good, 0.02, 0.98) if len(patterns) else np.zeros(0)
    votes, prior = towards, 0.85
    for _ in range(rounds):
        new = np.empty_like(votes)
        for y, p in ((0, 1 - p_good), (1, p_good)):
            mass = (p * counts)[:, None, None] * (patterns[:, :, None] == np.array([-1, 0, 1]))
            new[y] = mass.sum(0) + weight[y] * towards[y]
            new[y] /= new[y].sum(1, keepdims=True)
        prior = float(np.clip(((p_good * counts).sum() + 0.85 * weight[1]) / (total + weight[1]), 0.01, 0.99))
        moved = np.abs(new - votes).max()
        votes = new
        logit = math.log(prior / (1 - prior)) + np.log(votes[1] / votes[0])[
            np.arange(n_rules)[None, :], patterns + 1].sum(1) if len(patterns) else np.zeros(0)
        p_good = 1 / (1 + np.exp(-logit))
        if moved < 1e-9:
            break
    return VoteModel(prior, votes)


def rule_votes(counts: Column) -> list[Column]:
    return [rule(counts).cast("tinyint") for rule in RULES.values()]


def fit(counted: DataFrame) -> VoteModel:
    """The model of all documents (``res`` as from ``with_counts``)."""
    votes = [v.alias(name) for name, v in zip(RULES, rule_votes(F.col("res")), strict=True)]
    rows = counted.select(*votes).groupBy(*RULES).count().orderBy(*RULES).collect()
    patterns = np.array([[r[n] for n in RULES] for r in rows], np.int64).reshape(len(rows), len(RULES))
    return fit_votes(patterns, np.array([r["count"] for r in rows], np.float64))


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])


def judge(counted: DataFrame, model: VoteModel) -> DataFrame:
    """``row``, ``res``, base_failed, probability (of good) and kept."""
    c = F.col("res")
    p = model.probability(rule_votes(c))
    return counted.select("row", "res", base_failed(c).alias("base_failed"), p.alias("probability"),
                          (~base_failed(c) & (p >= 0.5)).alias("kept"))


def filter_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents judged good, with their own columns.

    The texts are read twice (votes, then verdicts): a second read costs less
    than moving every text to meet its verdict.
    """
    model = fit(with_counts(docs, text, keep=[]))
    return judge(with_counts(docs, text), model).where("kept").select("row.*")
