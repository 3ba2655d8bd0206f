"""Merkle dataset manifest over a tree of SHA-256 midstates.

Every row is a leaf, the hash of its fields; per group (source) leaves stand in
the order of an id, and every ``FAN`` neighbours are hashed into a parent until
one node, the subroot, is left; the subroots, in the order of their groups,
are joined into the root the same way.  A digest enters its parent as 64 hex
characters, one whole SHA-256 block.

While a parent is hashed it keeps a copy of the hash state before each of its
child slots.  When a leaf is replaced, folding resumes at every level the state
kept before its slot and feeds the replacement and the siblings to its right
only; nothing to its left is hashed again.

On Spark the tree is cut into blocks of ``FAN ** HEIGHT`` neighbours, so a group
of any size spreads over many tasks and no task holds more than one block.  One
round up turns each block into one node (a few rounds reach the top); one round
down hands each block the path above it, as the bytes left and right of it on
every level; the block hashes the left ones once and folds all its rows
through the states.  Only digests are shuffled, never texts.  A manifest can be
kept; changes of a few rows are folded against it by the blocks they touch.

Defined cases: a null field is ``-`` (unlike an empty one, ``0:``); a null group
is a group and comes first, as does a null id in its group; rows that tie on
(group, id) stand in the order of their leaves, equal ones are leaves of their
own; a group of one row is its own subroot; an empty table has no rows and no
root; other columns are carried along, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..operators.ordered import row_numbers
from ..session import discard, materialize

FAN = 3
#: Levels of a block: 3^6 = 729 neighbours, a few hundred kilobytes.
HEIGHT = 6
BLOCK = FAN ** HEIGHT

#: The bytes hashed before and after a node on each level above it.
PATH = "array<struct<left: binary, right: binary>>"
_PATH = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))


class Parent:
    """A hashed run of children; ``states[i]`` is the hash state before child i."""

    __slots__ = ("children", "states", "digest")

    def __init__(self, children: Sequence[bytes]) -> None:
        state, self.children, self.states = hashlib.sha256(), children, []
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def right(self, slot: int) -> bytes:
        return b"".join(self.children[slot + 1:])

    def left(self, slot: int) -> bytes:
        return b"".join(self.children[:slot])


def resume(state, value: bytes, right: bytes) -> bytes:
    """The digest that a parent has with ``value`` in the slot of ``state``."""
    state = state.copy()
    state.update(value + right)
    return state.hexdigest().encode()


def grow(nodes: list[bytes], levels: int | None) -> list[list[Parent]]:
    """The parents above ``nodes``, level by level: ``levels`` of them, or as
    many as it takes to come to one node."""
    rows = []
    while len(nodes) > 1 if levels is None else len(rows) < levels:
        rows.append([Parent(nodes[i:i + FAN]) for i in range(0, len(nodes), FAN)])
        nodes = [p.digest for p in rows[-1]]
    return rows


def levels_of(n: int) -> int | None:
    """Levels of a block of a group with ``n`` nodes: its last block ends at
    the top, any other is ``HEIGHT`` high."""
    return HEIGHT if n > BLOCK else None


def field(column: str | Column) -> Column:
    """A field as it enters a leaf: ``-`` for null, else its UTF-8 length, a colon and the value."""
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(*fields: str | Column) -> Column:
    """The hash of a row: its fields, concatenated."""
    return F.sha2(F.concat(*[field(f) for f in fields]).cast("binary"), 256)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Runs of rows of one (gid, block) from rows sorted by them."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (held[0]["gid"], held[0]["block"]) != (row["gid"], row["block"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _pathed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict, list[dict]]]:
    """The path of each block, and its nodes (``with_paths``)."""
    for above, *nodes in _blocks(batches):
        if nodes:
            yield above, nodes


def _by_block(nodes: DataFrame, *more: str) -> DataFrame:
    return nodes.repartition("gid", "block").sortWithinPartitions("gid", "block", *more)


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """``nodes``: (gid, pos from 0, n of the group, digest).  The nodes of every
    round, the given ones first, and the tops: (gid, digest)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        for rows in _blocks(batches):
            digests = [bytes(r["digest"]) for r in rows]
            parents = grow(digests, levels_of(rows[0]["n"]))
            done.append((rows[0]["gid"], rows[0]["block"], -(-rows[0]["n"] // BLOCK),
                         parents[-1][0].digest if parents else digests[0]))
            if len(done) == 4096:
                yield _batch(done, _NODE)
                done = []
        yield _batch(done, _NODE)

    rounds, tops = [nodes], None
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        up = _by_block(rounds[-1].withColumn("block", F.floor(F.col("pos") / BLOCK)), "pos")
        up = materialize(up.select("gid", "block", "n", "digest").mapInArrow(
            run, "gid long, pos long, n long, digest binary"), "merkle-nodes")
        ended = up.where("n = 1").select("gid", "digest")
        tops = ended if tops is None else tops.unionByName(ended)
        most = -(-most // BLOCK)
        if most <= 1:
            return rounds, tops
        rounds.append(up.where("n > 1"))


_NODE = pa.schema([("gid", pa.int64()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())])
_DOWN = pa.schema([("gid", pa.int64()), ("block", pa.int64()), ("top", pa.binary()), ("path", _PATH)])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The path of every block of the first round: (gid, block, top, path).
    ``tops`` gives each group's own path and what else belongs to it as
    (gid, top, path)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for above, nodes in _pathed(batches):
            parents = grow([bytes(r["digest"]) for r in nodes], levels_of(nodes[0]["n"]))
            yield _batch([(above["gid"], r["pos"], above["top"], own_path(parents, i) + above["path"])
                          for i, r in enumerate(nodes)], _DOWN)

    ends = tops.select("gid", F.lit(0).cast("long").alias("block"), "top", "path")
    paths = None
    for r in range(len(rounds) - 1, 0, -1):
        # the groups that end with this round start from their tops
        ending = rounds[r].where(F.col("n") <= BLOCK).select("gid").distinct()
        start = ends.join(ending, "gid", "left_semi")
        paths = start if paths is None else start.unionByName(paths)
        below = with_paths(rounds[r].withColumn("block", F.floor(F.col("pos") / BLOCK)), paths, [])
        paths = materialize(below.mapInArrow(run, f"gid long, block long, top binary, path {PATH}"), "merkle-paths")
    if paths is None:
        return ends
    ended = rounds[0].where(F.col("n") <= BLOCK).select("gid").distinct()
    return ends.join(ended, "gid", "left_semi").unionByName(paths)


def with_paths(nodes: DataFrame, paths: DataFrame, more: list[str]) -> DataFrame:
    """The rows of each block in order, after a row (pos -1) with its path."""
    own = nodes.select("gid", "block", "pos", "n", "digest", *more,
                       F.lit(None).cast("binary").alias("top"), F.lit(None).cast(PATH).alias("path"))
    above = paths.withColumn("pos", F.lit(-1).cast("long"))
    return _by_block(own.unionByName(above, allowMissingColumns=True), "pos")


def own_path(parents: list[list[Parent]], at: int) -> list[dict]:
    """The bytes left and right of node ``at`` on every level of its block."""
    path = []
    for level in parents:
        at, slot = divmod(at, FAN)
        path.append({"left": level[at].left(slot), "right": level[at].right(slot)})
    return path


class Folder:
    """One block and the path above it: folds a replaced leaf to the root."""

    def __init__(self, digests: list[bytes], n: int, path: list[dict]) -> None:
        self.parents = grow(digests, levels_of(n))
        self.above = [(hashlib.sha256(step["left"]), step["right"]) for step in path]
        self.beside = b"".join(step["left"] + step["right"] for step in path)

    def fold(self, at: int, value: bytes) -> bytes:
        for level in self.parents:
            at, slot = divmod(at, FAN)
            value = resume(level[at].states[slot], value, level[at].right(slot))
        for state, right in self.above:
            value = resume(state, value, right)
        return value

    def proof(self, at: int) -> str:
        """The hash of the siblings from the leaf to the root."""
        found = hashlib.sha256()
        for level in self.parents:
            at, slot = divmod(at, FAN)
            found.update(level[at].left(slot) + level[at].right(slot))
        found.update(self.beside)
        return found.hexdigest()


@dataclass(frozen=True)
class Manifest:
    """The stored tree: ``leaves`` (row, gid, block, pos, n, digest, replaced),
    ``paths`` above every block (gid, block, top, path), and the root (None for
    an empty table)."""

    leaves: DataFrame
    paths: DataFrame
    root: str | None

    def write(self, path: str) -> None:
        """Keep the manifest under ``path``; changes are folded against it later."""
        for name in ("leaves", "paths"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")
        spark = self.leaves.sparkSession
        spark.createDataFrame([(self.root,)], "root string").coalesce(1).write.mode("overwrite").parquet(f"{path}/root")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Manifest:
        leaves, paths, root = (spark.read.parquet(f"{path}/{name}") for name in ("leaves", "paths", "root"))
        return cls(leaves, paths, root.first().root)

    def fold(self, leaves: DataFrame | None = None) -> DataFrame:
        """Per leaf with a ``replaced`` hash: row, leaf, subroot, root,
        proof_sha256, folded_root and verified."""
        leaves = self.leaves if leaves is None else leaves
        row_type = leaves.schema["row"].dataType
        kept = to_arrow_type(row_type)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for above, nodes in _pathed(batches):
                folder = Folder([bytes(r["digest"]) for r in nodes], nodes[0]["n"], above["path"])
                subroot = bytes(above["top"]).decode()
                own = [(r["row"], bytes(r["digest"]).decode(), subroot, folder.proof(i),
                        folder.fold(i, bytes(r["replaced"])).decode()) for i, r in enumerate(nodes) if r["replaced"] is not None]
                columns = zip(*own, strict=True) if own else [[]] * 5
                types = [kept, *[pa.string()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                                 names=["row", "leaf", "subroot", "proof_sha256", "folded_root"])

        joined = with_paths(leaves, self.paths, ["row", "replaced"])
        folded = joined.mapInArrow(run, f"row {row_type.simpleString()}, leaf string, subroot string, "
                                        "proof_sha256 string, folded_root string")
        return folded.select("row", "leaf", "subroot", F.lit(self.root).alias("root"), "proof_sha256", "folded_root",
                             (F.col("folded_root") == F.lit(self.root)).alias("verified"))

    def fold_changes(self, changes: DataFrame, key: str, leaf: str = "leaf") -> DataFrame:
        """The same for the rows that ``changes`` (``key``, a column of ``row``,
        and the new ``leaf`` hash) names: only their blocks are read and hashed."""
        new = changes.select(F.col(key).alias("k"), F.col(leaf).cast("binary").alias("new"))
        named = self.leaves.drop("replaced").join(new, F.col(f"row.{key}").eqNullSafe(F.col("k")), "left").withColumnRenamed(
            "new", "replaced").drop("k")
        touched = materialize(named.where("replaced is not null").select("gid", "block").distinct(), "merkle-touched")
        own = Manifest(self.leaves, self.paths.join(touched, ["gid", "block"], "left_semi"), self.root)
        return own.fold(named.join(touched, ["gid", "block"], "left_semi"))


def build(rows: DataFrame, group: str, order: str, leaf: Column, keep: Sequence[str] = (),
          replaced: Column | None = None) -> Manifest:
    """The manifest of ``rows``: per ``group`` the leaves by ``order``.
    ``replaced`` is a hash to fold in for the row (the leaf itself proves it)."""
    spark = rows.sparkSession
    hashed = rows.select(F.struct(*keep, F.lit(0).alias("_")).alias("row"), F.col(group).cast("string").alias("grp"),
                         F.col(order).alias("ord"), leaf.alias("leaf"),
                         (F.lit(None) if replaced is None else replaced).cast("string").alias("replaced"))
    placed = materialize(row_numbers(hashed, ["ord", "leaf"], by=["grp"], out="pos"), "merkle-leaves")
    groups = placed.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    groups = materialize(row_numbers(groups, ["grp"], out="gid"), "merkle-groups")
    leaves = materialize(
        placed.join(groups.withColumnRenamed("grp", "g"), F.col("grp").eqNullSafe(F.col("g")))
        .select("row", "gid", F.floor((F.col("pos") - 1) / BLOCK).alias("block"), (F.col("pos") - 1).alias("pos"), "n",
                F.col("leaf").cast("binary").alias("digest"), F.col("replaced").cast("binary").alias("replaced")), "merkle-placed")
    discard(placed)

    rounds, tops = climb(leaves.select("gid", "pos", "n", "digest"))
    n_groups = tops.count()
    upper = tops.select(F.lit(0).cast("long").alias("gid"), (F.col("gid") - 1).alias("pos"),
                        F.lit(n_groups).cast("long").alias("n"), "digest")
    upper_rounds, root = climb(upper)
    root = root.first()
    start = spark.createDataFrame([(0, b"", [])], f"gid long, top binary, path {PATH}")
    upper_paths = descend(upper_rounds, start)

    def paths_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for above, nodes in _pathed(batches):
            parents = grow([bytes(r["digest"]) for r in nodes], levels_of(nodes[0]["n"]))
            yield _batch([(r["pos"] + 1, 0, bytes(r["digest"]), own_path(parents, i) + above["path"])
                          for i, r in enumerate(nodes)], _DOWN)

    upper = upper.withColumn("block", F.floor(F.col("pos") / BLOCK))
    tops = materialize(with_paths(upper, upper_paths, []).mapInArrow(
        paths_of, f"gid long, block long, top binary, path {PATH}"), "merkle-tops").drop("block")
    return Manifest(leaves, descend(rounds, tops), bytes(root.digest).decode() if root else None)


def without_breaks(text: Column) -> Column:
    """The tampering of the contract: a text without its line breaks."""
    return F.replace(text, F.lit("\n"), F.lit(""))


def document_manifest(docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
                      group: str = "source", order: str = "doc_id", text: str = "text") -> DataFrame:
    """The manifest of documents; every second one by its id's crc32 is folded
    as if its text had lost its line breaks."""
    own = leaf(*fields)
    tampered = leaf(*[without_breaks(F.col(text)) if f == text else f for f in fields])
    touched = F.crc32(F.encode(F.col(order).cast("string"), "utf-8")) % 2 == 0
    return build(docs, group, order, own, [order], F.when(touched, tampered).otherwise(own)).fold()
