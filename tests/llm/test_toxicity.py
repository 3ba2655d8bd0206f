from __future__ import annotations

import random
import zlib

import pytest
from messy import empty, messy, prose

from tributary.llm import toxicity

INSULTS = ["blockhead", "numbskull", "halfwit", "dimwit"]


def corpus(n=700):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.2)
        words = prose(i, rng.randrange(20, 200)).split()
        for _ in range(rng.randrange(2, 6) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def learnt(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return docs, table, toxicity.learn(docs, table)


def test_held_out_accuracy(spark, learnt):
    docs, table, model = learnt
    got = {r.doc_id: r.score for r in toxicity.score(docs, model, keep=["doc_id"]).select("row.doc_id", "res.score").collect()}
    truth = {r.doc_id: r.toxic for r in table.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {r.doc_id for r in table.where(toxicity.held_out(table["doc_id"])).collect()} == set(held)
    assert sum((got[i] >= 0.5) == truth[i] for i in held) / len(held) > 0.95
    toxic, clean = [got[i] for i in held if truth[i]], [got[i] for i in held if not truth[i]]
    assert sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean)) > 0.97


def test_held_out_labels_teach_nothing(spark, learnt):
    docs, table, model = learnt
    flipped = table.selectExpr("doc_id", "quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) as toxic")
    again = toxicity.learn(docs, flipped)
    assert again.weights.tolist() == model.weights.tolist() and again.distance == model.distance


def test_a_single_insult_in_a_long_text_raises_the_largest_gain(learnt):
    model = learnt[2]
    long = prose(77, 4000)
    clean = model.distance.gains(long.encode())
    dirty = model.distance.gains((long + " you blockhead and numbskull").encode())
    assert dirty.max() > clean.max()


def test_messy_documents_and_labels(spark, learnt):
    _, table, model = learnt
    rows = toxicity.score(messy(spark), model).select("row.*", "res.score").collect()
    assert len(rows) == messy(spark).count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(empty(spark), model).count() == 0
    odd = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (None, 1, 1), (2, 1, None), (3, 1, 0), (3, 1, 0)],
                                "doc_id long, quality int, toxic int")
    assert toxicity.learn(messy(spark), odd) is not None
    for few, prior in ((table.limit(0), 0.0), (table.where("toxic = 1"), 1.0), (table.where("toxic = 0"), 0.0)):
        one = toxicity.learn(learnt[0], few)
        assert one.score(b"any text") == (prior, 0, 1)
    assert toxicity.learn(empty(spark), table).distance is None
