from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from messy import empty, hot, messy
from pyspark.sql import functions as F

from tributary.llm import token_orc
from tributary.llm.queries import tokenizer_file
from tributary.session import scratch_path

TEXTS = ["", " ", "\n", "a", " a", "a ", "a b", "a  b", "a\nb", "a\n\nb", "a \n b", "it's we'll 'tis don't", "x\ty z",
         "😀 naïve 　 wide space", " x y", "nul \x00 here", "<|endoftext|> <s>", "end\n", "\nstart", "tab\t",
         "a.b, c! (d) [e] 12 345.", "CamelCase  double", "\x1c sep \x85 nel", "é combining", "a" * 3000]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_file())
    t.encode_special_tokens = True
    return t


def expected(tokenizer, rows):
    """Per row in file order: (doc_id, start, n, crc)."""
    out, at = [], 0
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_encoder_equals_whole_texts(tokenizer):
    with open(tokenizer_file(), "rb") as f:
        encoder = token_orc.Encoder(f.read(), memory_units=20)
    for texts in (TEXTS, [None, *TEXTS[::-1]], TEXTS * 3, ["only one"], [""], ["qqz"], ["\n"], [" "]):
        ids, sizes = encoder.encode(pa.array(texts, pa.string()))
        want = [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
        assert sizes.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def read(spark, docs, **options):
    path = scratch_path(spark, "test-orc")
    token_orc.write_tokens(docs, path, tokenizer_file(), **options)
    rows = token_orc.with_crc32(token_orc.read_tokens(spark, path), ["doc_id", "start", "n_tokens"]).collect()
    return path, sorted((tuple(r) for r in rows), key=lambda r: r[1])


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_round_trip_in_document_order(spark, tokenizer, shards):
    docs = hot(spark, 90)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    path, got = read(spark, docs, shards=shards)
    assert got == expected(tokenizer, rows)
    some = token_orc.read_documents(spark, path, [4, 77]).collect()
    assert {r.doc_id for r in some} == {4, 77}
    assert "PushedFilters: [In(doc_id" in token_orc.read_documents(spark, path, [4, 77])._jdf.queryExecution().toString()


def test_messy_documents(spark, tokenizer):
    docs = messy(spark)
    path, got = read(spark, docs, shards=4)
    by_hash = docs.selectExpr("doc_id", "text", "xxhash64(text) h").collect()
    ordered = sorted(by_hash, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    assert got == expected(tokenizer, [(r.doc_id, r.text) for r in ordered])
    assert read(spark, empty(spark))[1] == []
    assert spark.read.orc(path).columns == ["doc_id", "shard", "shard_start", "n_tokens", "ids"]


def test_added_tokens_get_the_ids_of_the_library(spark):
    from tokenizers import Tokenizer
    default = Tokenizer.from_file(tokenizer_file())
    texts = ["a b", "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y  z", " <|endoftext|>\n<|endoftext|>", "<|endoftext", "c d"]
    assert 50256 in default.encode(texts[1], add_special_tokens=False).ids
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert read(spark, docs, shards=2)[1] == expected(default, list(enumerate(texts)))
    as_text = Tokenizer.from_file(tokenizer_file())
    as_text.encode_special_tokens = True
    assert read(spark, docs, shards=2, special_as_text=True)[1] == expected(as_text, list(enumerate(texts)))


def test_files_hold_bloom_filters_and_other_stripes_are_skipped(spark):
    """Looked up through the ORC library itself: the Bloom filter's streams and
    the row index are there, and a look-up reads the rows of one shard only."""
    docs = hot(spark, 120).withColumn("doc_id", F.col("doc_id") * 3)
    path, rows = read(spark, docs, shards=10)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in spark.read.orc(path).inputFiles():
        orc = jvm.org.apache.orc.OrcFile
        reader = orc.createReader(jvm.org.apache.hadoop.fs.Path(name), orc.readerOptions(conf))
        records = reader.rows()
        for stripe in reader.getStripes():
            kinds = {(s.getColumn(), s.getKind().toString()) for s in records.readStripeFooter(stripe).getStreamsList()}
            assert {(1, "BLOOM_FILTER_UTF8"), (1, "ROW_INDEX")} <= kinds
        assert reader.getStripes().size() and reader.getRowIndexStride() > 0
    for wanted, found in ((150, 1), (151, 0)):
        plan = token_orc.read_documents(spark, path, [wanted])._jdf.queryExecution().executedPlan()
        assert len(plan.executeCollect()) == found
        read_rows = plan.collectLeaves().head().metrics().apply("numOutputRows").value()
        assert read_rows <= len(rows) / 4


def test_full_memory_keeps_the_units_of_several_groups(tokenizer, monkeypatch):
    with open(tokenizer_file(), "rb") as f:
        encoder = token_orc.Encoder(f.read(), memory_units=40)
    asked = []
    plain = token_orc.Encoder._encode_plain
    monkeypatch.setattr(token_orc.Encoder, "_encode_plain", lambda self, texts: asked.extend(texts) or plain(self, texts))
    for i in range(30):
        texts = [" often seen\nwords", *(f" rare{i}x{j} often" for j in range(10)), " "]
        ids, sizes = encoder.encode(pa.array(texts))
        want = [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
        assert ids.tolist() == [x for w in want for x in w] and sizes.tolist() == [len(w) for w in want]
        assert len(encoder.number) < 60
    assert sum(" often" in t for t in asked) == 1 and sum("rare" in t for t in asked) == 30


def test_remembered_units_are_no_python_objects(tokenizer):
    """A text per unit in Python's memory costs a hash and a look-up of each in every group."""
    import tracemalloc
    with open(tokenizer_file(), "rb") as f:
        encoder = token_orc.Encoder(f.read())
    encoder.encode(pa.array(["a b"]))
    texts = [" ".join(f"w{i}x{k}" for k in range(40)) for i in range(2500)]  # 100,000 units
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        ids, sizes = encoder.encode(pa.array(texts))
        held = tracemalloc.get_traced_memory()[0] - before - ids.nbytes - sizes.nbytes
    finally:
        tracemalloc.stop()
    assert held < 70 * 100_000  # ids, places and counts
    assert ids.tolist() == [t for x in texts for t in [*tokenizer.encode(x, add_special_tokens=False).ids, 2]]
    again, _ = encoder.encode(pa.array(["zz new", *texts]).slice(1))
    assert np.array_equal(ids, again)
    assert [x.tolist() for x in encoder.encode(pa.array([], pa.string()))] == [[], []]
