from __future__ import annotations

import re

import numpy as np
from messy import empty, messy, prose, same_rows

from tributary.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = set()
    for i, g in enumerate(grams):
        if any(h == g and j != i for j, h in enumerate(grams)):
            covered |= set(range(i, i + 5))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_match_brute_force(spark):
    cases = [prose(1, 60), "", None, "a b c d e a b c d e", "x\ny\nx\n \n \nx \n", "#*$%&|<> # é*", "w " * 30,
             "a a a a a a", "é ü ß \x0b \x0c t", prose(2, 30) + "\n" + prose(2, 30)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "doc_id long, text string")
    for r in quality.with_counts(docs).select("row.*", "res.*").collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text), r.text


def junk(i):
    base = prose(i, 60).split()
    return [" | ".join(base), " ".join(w.upper() + "!!" for w in base), " ".join(base[:4] * 20),
            " ".join(w + "&&&" for w in base)][i % 4]


def test_junk_goes_and_prose_stays(spark):
    rows = [(i, junk(i) if i % 8 == 0 or i % 8 == 5 else prose(i, 30 + i)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in quality.filter_quality(docs).collect()}
    assert kept == {i for i in range(400) if i % 8 not in (0, 5)}


def test_em_recovers_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.8
    votes = np.where(rng.random((20_000, 5)) < 0.4, np.where(rng.random((20_000, 5)) < 0.9, 1, -1) * np.where(good, 1, -1)[:, None], 0)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_votes(patterns, counts.astype(float))
    assert abs(model.prior - 0.8) < 0.05
    assert np.abs(model.accuracies - 0.9).max() < 0.06


def test_messy_documents(spark):
    docs = messy(spark)
    kept = quality.filter_quality(docs)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, None, 8, 11, 14}
    assert same_rows(kept, docs.where("doc_id in (1, 2, 3, 8, 11, 14) or doc_id is null"))
    assert quality.filter_quality(empty(spark)).count() == 0


def test_em_and_not_the_limits_decides_over_a_spoiled_detector():
    """Votes as the rules cast them: ten detectors vote bad or abstain, two rules
    vote good or abstain.  One detector votes at random: the first guess (a bad
    vote outweighs a good one) drops what it hits, EM finds it out."""
    rng = np.random.default_rng(2)
    n = 20_000
    good = rng.random(n) < 0.85
    votes = np.zeros((n, 12), np.int64)
    votes[:, 1:10] = -1 * (rng.random((n, 9)) < np.where(good, 0.003, 0.35)[:, None])
    votes[:, 0] = -1 * (rng.random(n) < 0.35)
    votes[:, 10:] = rng.random((n, 2)) < np.where(good, 0.85, 0.15)[:, None]
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = quality.fit_votes(patterns, counts.astype(float))
    logit = np.log(model.prior / (1 - model.prior)) + model.log_odds[np.arange(12)[None, :], patterns + 1].sum(1)
    kept = (logit >= 0)[inverse.ravel()]
    guess = (2 * (votes < 0).sum(1) <= (votes > 0).sum(1))
    assert (kept == good).mean() > 0.975 and (guess == good).mean() < 0.92
    assert model.accuracies[0] < 0.35 and model.accuracies[1:].min() > 0.85
    sound = quality.fit_votes(*np.unique(votes[:, 1:], axis=0, return_counts=True))
    assert np.abs(sound.accuracies - model.accuracies[1:]).max() < 0.02  # the others are judged as without it
