from __future__ import annotations

import hashlib
import zlib

import pytest
from messy import empty, messy, messy_rows
from pyspark.sql import functions as F

from tributary.llm import merkle


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text) -> str:
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def up(nodes: list[str]) -> tuple[str, list[list[tuple[list[str], list[str]]]]]:
    """The top of a tree by plain hashing, and each node's siblings level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at, strict=True):
            run = nodes[i // 3 * 3:i // 3 * 3 + 3]
            path.append((run[:i % 3], run[i % 3 + 1:]))
        at = [i // 3 for i in at]
        nodes = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def brute(rows: list[tuple]) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars) rows to the contract's rows."""
    groups: dict = {}
    for doc_id, text, lang, source, n_chars in rows:
        leaf, bad = (leaf_of(doc_id, source, lang, n_chars, t) for t in
                     (text, None if text is None else text.replace("\n", "")))
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf, bad if hit else leaf, doc_id))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [up([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order]
    root, tops = up([t for t, _ in trees])
    out = []
    for s, (subroot, paths), top in zip(order, trees, tops, strict=True):
        for (*_, leaf, value, doc_id), path in zip(sorted(groups[s], key=lambda x: x[:3]), paths, strict=True):
            proof = ""
            for left, right in path + top:
                proof += "".join(left + right)
                value = h(*left, value, *right)
            out.append((doc_id, leaf, subroot, root, h(proof), value, value == root))
    return sorted(out, key=str)


def found(docs) -> list[tuple]:
    rows = merkle.document_manifest(docs).select("row.doc_id", "leaf", "subroot", "root", "proof_sha256",
                                                 "folded_root", "verified").collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("height", [1, 2, 6])
def test_messy_rows_against_plain_hashing(spark, monkeypatch, height):
    """Blocks of 3, 9 and 729 neighbours: the rounds do not show in the rows."""
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "BLOCK", 3 ** height)
    rows = [r[:5] for r in messy_rows()]
    rows += [(100 + i, f"line {i}\nnext\n", "en", "hot", i) for i in range(60)]
    rows += [(500 + i, "x", "en", f"s{i:02d}", 1) for i in range(14)] + [(7, "same", "en", "hot", 4)] * 7
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    result = found(docs.repartition(5))
    assert result == brute(rows)
    assert {r[-1] for r in result} == {True, False}


def test_extra_columns_and_empty_table(spark):
    assert found(messy(spark)) == brute([r[:5] for r in messy_rows()])
    assert found(empty(spark)) == []


def test_one_row_is_its_own_root(spark):
    rows = [(1, "a\nb", "en", None, 3)]
    (row,) = found(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert row[1] == row[2] == row[3] and row[4] == h("")


def test_folding_resumes_the_state_before_the_slot():
    children = [h(c).encode() for c in "abc"]
    parent = merkle.Parent(children)
    assert len(parent.states) == 3
    for slot in range(3):
        new = h("new").encode()
        expected = merkle.Parent([*children[:slot], new, *children[slot + 1:]]).digest
        assert merkle.resume(parent.states[slot], new, parent.right(slot)) == expected
        assert merkle.resume(parent.states[slot], children[slot], parent.right(slot)) == parent.digest


def test_fields_of_a_leaf(spark):
    df = spark.createDataFrame([(None, ""), ("é", "a")], "a string, b string")
    got = [tuple(r) for r in df.select(merkle.field("a"), merkle.field("b")).collect()]
    assert got == [("-", "0:"), ("2:é", "1:a")]
    assert [r[0] for r in df.select(merkle.leaf("a", F.col("b"))).collect()] == [h("-0:"), h("2:é1:a")]


def test_changes_fold_against_a_kept_manifest(spark, monkeypatch, tmp_path):
    """A manifest read back: changed leaves give the root of the changed table,
    and only the blocks they touch are folded."""
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    monkeypatch.setattr(merkle, "BLOCK", 3)
    rows = [(i, f"text {i}", "en", f"s{i % 4}", i) for i in range(80)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    merkle.build(spark.createDataFrame(rows, schema), "source", "doc_id", merkle.leaf(*fields), ["doc_id"]).write(str(tmp_path))
    kept = merkle.Manifest.read(spark, str(tmp_path))
    assert kept.fold().count() == 0  # nothing to fold
    for changed in (7, 79):
        other = [(i, "changed" if i == changed else t, *r) for i, t, *r in rows]
        new = spark.createDataFrame([other[changed]], schema).select("doc_id", merkle.leaf(*fields).alias("leaf"))
        (folded,) = kept.fold_changes(new, "doc_id").collect()
        assert (folded.row.doc_id, folded.root, folded.verified) == (changed, kept.root, False)
        assert folded.folded_root == brute(other)[0][3]
    same = spark.createDataFrame(rows[3:5], schema).select("doc_id", merkle.leaf(*fields).alias("leaf"))
    assert [r.verified for r in kept.fold_changes(same, "doc_id").collect()] == [True, True]
