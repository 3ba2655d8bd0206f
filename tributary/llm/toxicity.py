"""Toxicity by compression distance with two zstandard dictionaries.

One dictionary is trained on ordinary text, one on what toxic texts repeat and
ordinary ones do not.  A text is cut into windows of a few words; a window is
compressed with the ordinary dictionary alone and with the toxic one before
it, and its gain is the bytes the toxic dictionary saves.  The largest gains
of a text and the share of windows over a calibrated threshold give its score,
by a logistic curve fitted on documents that the dictionaries had not seen.

Labels are learnt from a bounded sample: at most ``TOXIC_SAMPLE`` toxic and
``ORDINARY_SAMPLE`` ordinary documents of at most ``SAMPLE_CHARS`` characters,
the smallest by a hash of the id.  Scoring covers every window of every text,
in the task that read it.

Defined cases: a null or empty text is one empty window without gain; rows
that repeat an id are scored alike; of contradicting labels of an id, toxic
counts; a null id or label teaches nothing, and a null id is not held out;
without labels of both classes every score is the share of toxic labels (0
without any).  Extra columns are not read.
"""

from __future__ import annotations

import heapq
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textmap import alnum_words, map_texts

TOXIC_SAMPLE = 1000
ORDINARY_SAMPLE = 2000
SAMPLE_CHARS = 32_768
WINDOW_WORDS = 8
TAIL_BYTES = 96
#: Short matches, found greedily: fast, and steady from window to window.
MATCHING = {"window_log": 17, "chain_log": 16, "hash_log": 16, "search_log": 6, "min_match": 4, "target_length": 16,
            "strategy": zstandard.STRATEGY_GREEDY, "write_content_size": False, "write_checksum": False,
            "write_dict_id": False}
ORDINARY_BYTES = 1 << 16
TOXIC_BYTES = 1 << 11
GRAM = 6
TELLING_GRAMS = 400
RATIO = 3
#: Thresholds: quantiles of the gains of unseen ordinary windows, and their least values.
QUANTILES = ((1.0, 0.99), (2.0, 0.999), (3.0, 0.9999))
FOLDS = 3

_RESULT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("max_gain", T.LongType()),
                        T.StructField("n_windows", T.LongType())])


def windows(text: bytes | None, words: int = WINDOW_WORDS) -> list[bytes]:
    """Normalised words in groups, each with a space at both ends."""
    own = alnum_words(text)
    return [b" " + b" ".join(own[i:i + words]) + b" " for i in range(0, len(own), words)] or [b""]


def _grams(text: bytes) -> set[bytes]:
    return {text[i:i + GRAM] for i in range(len(text) - GRAM + 1)}


def _train(size: int, samples: list[bytes], segment: int) -> bytes:
    """A trained dictionary; too few samples serve as they are."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=GRAM).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def telling_grams(often: Counter, seldom: Counter, n_toxic: int, n_ordinary: int) -> set[bytes]:
    """The letter groups whose share of toxic documents exceeds ``RATIO`` times
    their share of ordinary ones by most."""
    least = 3 if n_toxic >= 50 else 2
    excess = {g: n / n_toxic - RATIO * (seldom[g] + 0.5) / n_ordinary for g, n in often.items() if n >= least}
    return {g for g in heapq.nlargest(TELLING_GRAMS, excess, key=lambda g: (excess[g], g)) if excess[g] > 0}


def telling_runs(toxic: list[bytes], telling: set[bytes]) -> list[bytes]:
    """The stretches of texts that telling letter groups make up."""
    runs = []
    for text in toxic:
        covered = np.zeros(len(text) + 2, np.int8)
        for i in range(len(text) - GRAM + 1):
            if text[i:i + GRAM] in telling:
                covered[i + 1:i + 1 + GRAM] = 1
        edges = np.flatnonzero(np.diff(covered))
        runs += [text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
    return runs


def completed(dictionary: bytes, runs: list[bytes], size: int) -> bytes:
    """The trained dictionary after the frequent words of the runs that it
    lacks: training picks segments by score and can miss some."""
    words = Counter(w for run in runs for w in set(run.split()) if len(w) >= GRAM - 1)
    lacking = [b" " + w + b" " for w, n in sorted(words.items(), key=lambda x: (-x[1], x[0]))
               if n >= 2 and w not in dictionary]
    return b"".join(lacking)[:size] + dictionary


@dataclass
class Distance:
    """The two dictionaries as compressors."""

    ordinary: bytes
    toxic: bytes
    _made: list = field(default_factory=list, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return {"ordinary": self.ordinary, "toxic": self.toxic, "_made": []}

    def _compressors(self) -> list:
        if not self._made:
            for content in (self.ordinary, self.toxic + self.ordinary):
                params = zstandard.ZstdCompressionParameters(**MATCHING)
                d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(compression_params=params)
                self._made.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))
        return self._made

    def gains(self, text: bytes | None) -> np.ndarray:
        """Per window: the bytes saved by the toxic dictionary.

        Each window is followed by the end of the ordinary dictionary, which
        both know: a window too short to shrink would be stored as it is, and
        every distance would be the same.
        """
        plain, toxic = (c.compress for c in self._compressors())
        known = self.ordinary[-TAIL_BYTES:]
        return np.array([len(plain(w + known)) - len(toxic(w + known)) for w in windows(text)], np.float64)


def _features(gains: np.ndarray, thresholds: list[float]) -> list[float]:
    """Largest gains, how many windows pass each threshold, mean gain, length."""
    top = np.sort(gains)[::-1]
    return [1.0, top[0], top[1] if len(top) > 1 else 0.0, *(float((gains > t).sum()) ** 0.5 for t in thresholds),
            float(gains.mean()), float(np.log(len(gains)))]


@dataclass
class Model:
    distance: Distance | None
    thresholds: list[float]
    weights: np.ndarray
    prior: float

    def score(self, text: bytes | None) -> tuple[float, int, int]:
        if self.distance is None:
            return self.prior, 0, len(windows(text))
        gains = self.distance.gains(text)
        z = float(np.dot(_features(gains, self.thresholds), self.weights))
        return 1 / (1 + float(np.exp(-np.clip(z, -30, 30)))), int(gains.max()), len(gains)


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a light ridge, by Newton steps."""
    mean, sd = x.mean(0), x.std(0)
    mean[0], sd[0] = 0, 1
    sd[sd == 0] = 1
    z, beta = (x - mean) / sd, np.zeros(x.shape[1])
    ridge = 0.05 * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (w * p * (1 - p))[:, None]).T @ z + ridge, z.T @ (w * (y - p)) - ridge @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    beta = beta / sd
    beta[0] -= (beta[1:] * mean[1:]).sum()
    return beta


def fit(toxic: list[bytes], ordinary: list[bytes], prior: float) -> Model:
    """Train the dictionaries; calibrate on gains that dictionaries of the
    other folds give."""
    if not toxic or not ordinary:
        return Model(None, [], np.zeros(0), prior)
    normal = [[b" " + b" ".join(alnum_words(t)) + b" " for t in side] for side in (toxic, ordinary)]
    folds = FOLDS if min(len(toxic), len(ordinary)) >= 2 * FOLDS else 1

    def counted(texts: list[bytes], fold: int) -> Counter:
        out: Counter = Counter()
        for t in texts[fold::folds]:
            out.update(_grams(t))
        return out

    counts = [[counted(side, f) for f in range(folds)] for side in normal]

    def distance(without: int | None) -> Distance:
        used = [f for f in range(folds) if f != without or folds == 1]
        own = [[t for f in used for t in side[f::folds]] for side in normal]
        often, seldom = (sum((side[f] for f in used), Counter()) for side in counts)
        telling = telling_grams(often, seldom, len(own[0]), len(own[1]))
        runs = telling_runs(own[0], telling)
        # The ordinary dictionary must not know the telling groups either.
        cut = [w for f in used for t in ordinary[f::folds] for w in windows(t) if telling.isdisjoint(_grams(w))]
        return Distance(_train(ORDINARY_BYTES, cut, 64), completed(_train(TOXIC_BYTES, runs, 16), runs, TOXIC_BYTES))

    gains, label = [], []
    for f in range(folds):
        unseen = distance(f)
        for y, side in ((1, toxic), (0, ordinary)):
            for t in side[f::folds]:
                gains.append(unseen.gains(t))
                label.append(y)
    y = np.array(label, np.float64)
    plain = np.concatenate([g for g, one in zip(gains, label, strict=True) if not one])
    thresholds = [max(least, float(np.quantile(plain, q))) for least, q in QUANTILES]
    x = np.array([_features(g, thresholds) for g in gains])
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    return Model(distance(None), thresholds, _logistic(x, y, weight), prior)


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document are kept back from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on the bounded sample of the labels that are not held out."""
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(id_col))).groupBy(
        F.col(id_col).alias("l_id")).agg(F.max(label).alias("l_toxic"))
    n_toxic, n = usable.agg(F.sum((F.col("l_toxic") == 1).cast("long")), F.count(F.lit(1))).first()
    n_toxic = n_toxic or 0
    order = [F.xxhash64("l_id"), F.col("l_id")]
    chosen = usable.where("l_toxic = 1").orderBy(*order).limit(TOXIC_SAMPLE).unionByName(
        usable.where("l_toxic <> 1").orderBy(*order).limit(ORDINARY_SAMPLE))
    found = docs.select(F.col(id_col).alias("l_id"), F.col(text).cast("string").alias("t")).join(
        F.broadcast(chosen), "l_id").where(F.length("t") <= SAMPLE_CHARS).groupBy("l_id").agg(
        F.first("l_toxic").alias("y"), F.min("t").alias("t")).orderBy("l_id")
    rows = [(r.t.encode(), r.y == 1) for r in found.select("t", "y").collect()]  # at most the two samples
    return fit([t for t, y in rows if y], [t for t, y in rows if not y], n_toxic / n if n else 0.0)


def score(docs: DataFrame, model: Model, text: str = "text", keep: list | None = None) -> DataFrame:
    """``row`` (the kept columns) and ``res``: score, largest gain, windows."""
    def kernel():
        def run(texts):
            columns = zip(*(model.score(t) for t in texts), strict=True)
            return [pa.array(c, t) for c, t in zip(columns, (pa.float64(), pa.int64(), pa.int64()), strict=True)]
        return run
    return map_texts(docs, text, kernel, _RESULT, keep=keep)
