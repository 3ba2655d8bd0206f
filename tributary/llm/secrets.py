"""Secret scanning over an incremental ledger of blobs.

Every version of a path is named by the SHA-256 of its text.  A ledger (a
Parquet folder) records which blob was scanned by which rule version and what
was found; a scan takes only pairs it has not seen, appends them, and joins
the findings back to every path and version that holds the blob.  Copies of a
text are scanned once, a new rule version rescans without touching the others.

Only DataFrame and SQL functions are used.  A rule's spans come from the gaps
that ``split`` leaves and the matches of ``regexp_extract_all``: their lengths
add up to the code-point offsets, by prefix sums that double their reach.

Defined cases: a null text is the empty blob; repeated rows get the same
findings each; a null path is a path; texts of any length are scanned whole;
spans that start together stand in the order of the rules; scans that overlap
in time may record a pair twice, its findings count once; an empty table adds
nothing to the ledger.  Extra columns are not read, path columns may have any name.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..session import discard, materialize

FINDING = "array<struct<start:int,rank:int,kind:string,end:int>>"
LEDGER_SCHEMA = f"blob binary, rule string, findings {FINDING}"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and how long the match (group 0) or a
    group of it must be, else the match is dropped after it was consumed."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False

    @property
    def version(self) -> str:
        """The rule and a digest of its definition."""
        text = f"{self.pattern}\n{self.group}\n{self.least}"
        return f"{self.kind}@{hashlib.sha256(text.encode()).hexdigest()[:12]}"


# The patterns of the base kinds, then the method's own kinds.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9+/_.=-]{20,}"),
)


def blob_of(text: Column) -> Column:
    """The content address of a text: 32 bytes."""
    return F.unhex(F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256))


def running_sums(numbers: Column) -> Column:
    """Inclusive prefix sums of an array of integers, in O(n log n): round k
    adds to each entry the one 2^k places before it."""
    n = F.size(numbers)
    rounds = F.filter(F.sequence(F.lit(0), F.lit(30)), lambda k: F.pow(F.lit(2), k) < n)

    def double(sums: Column, k: Column) -> Column:
        step = F.pow(F.lit(2), k).cast("int")
        before = F.concat(F.array_repeat(F.lit(0), step), F.slice(sums, F.lit(1), n - step))
        return F.zip_with(sums, before, lambda x, y: x + y)

    return F.aggregate(rounds, numbers, double)


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's matches in a text as findings, in order."""
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    sizes = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.length)
    judged = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), F.length)
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(sizes)), sizes, lambda gap, size: gap + size)
    found = F.zip_with(running_sums(steps), F.arrays_zip(sizes.alias("size"), judged.alias("judged")),
                       lambda end, x: F.struct((end - x["size"]).alias("start"), F.lit(rank).alias("rank"),
                                               F.lit(rule.kind).alias("kind"), end.alias("end"),
                                               x["judged"].alias("judged")))
    kept = F.transform(F.filter(found, lambda x: x["judged"] >= rule.least), lambda x: x.dropFields("judged"))
    return F.when(text.rlike(rule.pattern), kept).otherwise(F.array().cast(FINDING))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger so far; empty where there is none yet."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def unseen(versions: DataFrame, ledger_path: str, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, todo): the blobs that lack a rule version in the ledger, and which.
    Only content addresses and the ledger's narrow columns are read and moved."""
    blobs = versions.select(blob_of(F.col(text).cast("string")).alias("blob")).distinct()
    now = F.array(*[F.lit(r.version) for r in rules])
    seen = read_ledger(versions.sparkSession, ledger_path).select("blob", "rule").where(
        F.array_contains(now, F.col("rule"))).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    todo = F.array_except(now, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").select("blob", todo.alias("todo")).where(F.size("todo") > 0)


def update_ledger(versions: DataFrame, ledger_path: str, text: str = "text",
                  rules: tuple[Rule, ...] = RULES) -> bool:
    """Scan every (blob, rule version) that the ledger lacks and append it;
    False if there was none, and then no text was moved.

    One row per new blob carries its text: copies within a map task fold into
    one before the shuffle.
    """
    todo = materialize(unseen(versions, ledger_path, text, rules), "secret-todo")
    if todo.isEmpty():
        return False
    texts = versions.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).select(
        blob_of(F.col("text")).alias("blob"), "text").groupBy("blob").agg(F.first("text").alias("text"))
    scanned = F.array(*[
        F.when(F.array_contains("todo", F.lit(r.version)), F.struct(
            F.lit(r.version).alias("rule"), spans(F.col("text"), r, i).alias("findings")))
        for i, r in enumerate(rules)])
    texts.join(todo, "blob").select("blob", F.inline(F.filter(scanned, lambda x: x.isNotNull()))).write.mode(
        "append").parquet(ledger_path)
    discard(todo)
    return True


def findings_of_paths(versions: DataFrame, ledger_path: str, path: list, text: str = "text",
                      rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``row`` (the path columns) and ``findings`` (sorted by start, then rule
    order) of every version, joined from the ledger; only blobs with findings
    travel, and pairs that two scans have both recorded count once."""
    ledger = read_ledger(versions.sparkSession, ledger_path).where(F.size("findings") > 0).where(
        F.col("rule").isin([r.version for r in rules]))
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    per_blob = ledger.groupBy("blob").agg(F.flatten(F.transform(F.collect_set(F.struct("rule", "findings")),
                                                                lambda x: x["findings"])).alias("f")).select(
        "blob", F.array_sort(F.transform("f", lambda x: F.struct(
            x["start"].alias("start"), rank[x["kind"]].alias("rank"), x["kind"].alias("kind"),
            x["end"].alias("end")))).alias("findings"))
    named = versions.select(F.struct(*path).alias("row"), blob_of(F.col(text).cast("string")).alias("blob"))
    return named.join(per_blob, "blob", "left").select(
        "row", F.coalesce("findings", F.array().cast(FINDING)).alias("findings"))


def scan_history(versions: DataFrame, ledger_path: str, path: list, text: str = "text",
                 rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Bring the ledger up to date with all versions, then report by path:
    ``row`` (the path columns) and ``findings``."""
    update_ledger(versions, ledger_path, text, rules)
    return findings_of_paths(versions, ledger_path, path, text, rules)
