"""The numbered queries: each operator over its whole table, and its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import table
from ..session import materialize, scratch_path
from . import (
    arc_warc,
    chat,
    decontaminate,
    hard_negatives,
    licenses,
    merkle,
    mixing,
    quality,
    repeats,
    secrets,
    simhash,
    token_orc,
    toxicity,
)
from .merkle_sql import manifest_sql

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """The place of a public tokenizer's file (installed, not in this repository)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def wrap(build):
        QUERIES[name] = build
        if sql:
            ORACLE[name] = sql.strip()
        return build
    return wrap


@query("op1_decontaminate", sql=r"""
WITH it AS (SELECT item_id, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM (SELECT item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az
                  FROM benchmark WHERE text IS NOT NULL)),
     win AS (SELECT DISTINCT item_id, w[i + 1:i + least(10, len(w))] AS g
             FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS i FROM it WHERE len(w) > 0)),
     lens AS (SELECT DISTINCT len(g) AS k FROM win),
     d AS (SELECT doc_id, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     dg AS (SELECT doc_id, k, i, w[i + 1:i + k] AS g
            FROM (SELECT doc_id, w, k, unnest(range(len(w) - k + 1)) AS i FROM d, lens WHERE len(w) >= k)),
     m AS (SELECT doc_id, i, k, item_id FROM dg JOIN win USING (g)),
     hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit
              FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM m)) GROUP BY doc_id),
     its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS l
             FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                               keep=["doc_id"])
    return found.select(
        "row.doc_id", "res.n_words", "res.n_hit", F.size("res.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("res.items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("res")).alias("contaminated"))


@query("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = quality.with_counts(table(spark, sf_dir, "documents"), keep=["doc_id"])
    counted = materialize(counted, "quality-counts")  # a few numbers a text, read twice
    judged = quality.judge(counted, quality.fit(counted))
    return judged.select("row.doc_id", "res.n_words", "res.word_chars", "res.n_symbols", "res.n_dup_lines",
                         "res.n_repeat_words", "base_failed", "kept", F.round("probability", 6).alias("probability"))


def token_rows(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Write the ids of all documents, read the files back."""
    path = scratch_path(spark, "tokens.orc")
    token_orc.write_tokens(docs, path, tokenizer_file(), **options)
    return token_orc.with_crc32(token_orc.read_tokens(spark, path), ["doc_id", "start", "n_tokens"])


@query("op4_token_orc")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rows(spark, table(spark, sf_dir, "documents"))


@query("op8_mixing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.rows.select("row.doc_id", F.col("m_size").alias("size"), "source_size", "target",
                             (F.col("m_size") * F.size("shards")).alias("taken"))


def span_text(findings) -> Column:
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def secrets_sql() -> str:
    """Per rule its matches and what lies between them; their lengths add up to the offsets."""
    def rule(rank: int, r: secrets.Rule) -> str:
        pattern = r.pattern.replace("'", "''")
        return (f"SELECT rid, {rank} AS rank, '{r.kind}' AS kind, {r.least} AS least, "
                f"regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {r.group}) AS j, "
                f"string_split_regex(t, '{pattern}') AS g FROM d")
    base = ", ".join(f"'{r.kind}'" for r in secrets.RULES if r.base)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.RULES if r.base)
    zeros = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.RULES if r.base)
    text = "kind || ':' || s || ':' || e"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
     k AS ({" UNION ALL ".join(rule(i, r) for i, r in enumerate(secrets.RULES))}),
     x AS (SELECT rid, rank, kind, least, length(m[i]) AS n, length(j[i]) AS judged,
                  sum(length(g[i]) + length(m[i])) OVER (PARTITION BY rid, rank ORDER BY i) AS e
           FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM k)),
     f AS (SELECT rid, rank, kind, e - n AS s, e FROM x WHERE judged >= least),
     p AS (SELECT rid, {counts}, string_agg({text}, ',' ORDER BY s, rank) FILTER (kind IN ({base})) AS base,
                  string_agg({text}, ',' ORDER BY s, rank) AS spans FROM f GROUP BY rid)
SELECT doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN p USING (rid)
"""


@query("op6_secrets", sql=secrets_sql())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, ledger = table(spark, sf_dir, "documents"), scratch_path(spark, "secret-ledger")
    secrets.update_ledger(docs, ledger)
    found = secrets.scan_history(docs, ledger, ["doc_id"])  # all pairs are known: nothing is scanned anew
    base = [r.kind for r in secrets.RULES if r.base]

    def number(kind: str) -> Column:
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "row.doc_id", *[number(k) for k in base],
        F.sha2(span_text(F.filter("findings", lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
        span_text(F.col("findings")).alias("spans"))


@query("op3_arc_to_warc", sql="""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
     d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
     f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id > first THEN first END AS refers_to
FROM f
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc, warc = scratch_path(spark, "pages-arc"), scratch_path(spark, "pages-warc")
    arc_warc.write_arc(table(spark, sf_dir, "pages"), arc)
    arc_warc.convert(spark, arc, warc)
    return arc_warc.read_warc(spark, warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_licenses")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("row.doc_id", "res.n_words", "res.n_base", "res.first_word", "res.last_word",
                        F.array_join("res.base_labels", ",").alias("base_labels"),
                        F.array_join("res.labels", ",").alias("labels"), "res.score",
                        F.array_join(F.transform("res.matches", lambda m: F.concat_ws(
                            ":", m["label"], m["first_word"], m["last_word"], m["edits"])), ",").alias("spans"))


CONTROL_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


@query("op9_chat", sql=r"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
     e AS (SELECT *, length(t) + len(regexp_extract_all(
               t, '\|<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>')) AS n
           FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
       CAST(coalesce(sum(length(t)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n + length(role) + 24) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(
        spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string"))
    stored = materialize(chat.expand(turns), "chat-examples", **chat.STORE_OPTIONS)
    return chat.digests(stored)


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select("row.doc_id", toxicity.held_out(F.col("row.doc_id")).alias("held_out"), "res.score",
                         (F.col("res.score") >= 0.5).cast("int").alias("predicted"))


@query("op11_merkle", sql=manifest_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.document_manifest(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query("op13_repeats")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"], with_kept=False)
    return found.select("row.doc_id", "res.n_bytes", "res.n_removed", "res.n_spans", "res.kept_sha256")


@query("op12_hard_negatives", sql="""
WITH q AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                  CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
           FROM q a JOIN q b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
     p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
            AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0,
                               label=hard_negatives.shifted_label())
