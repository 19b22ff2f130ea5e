"""The registered queries of this folder: production parameters, whole tables, whole results."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    kneser_ney,
    licenses,
    quality,
    resampling,
    sampling,
    setsketch,
    simhash,
    spelling,
    sql,
    suffixes,
    toxicity,
    warc,
)
from tidemark.session import checkpoint_root

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        QUERIES[name] = Query(build, oracle)
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def classified(scored: DataFrame, limit: float) -> DataFrame:
    """The columns of a classifier's report: id, whether it was held out, score and decision."""
    return scored.select(
        "doc_id",
        (sampling.fold("doc_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= limit).cast("int").alias("predicted"),
    )


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return classified(quality.score(docs, model), 0.3)


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return classified(toxicity.score(docs, model), 0.5)


@query("op3_lm_scoring")
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = kneser_ney.held_out_scores(table(spark, sf_dir, "documents"))
    first = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return scored.select(*first, *[c for c in scored.columns if c not in first])


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


@query(
    "op5_warc",
    """
    SELECT page_id, n AS payload_bytes, sha256(h) AS payload_digest,
           CASE WHEN n >= 100 AND page_id <> f THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 100 AND page_id <> f THEN f END AS refers_to
    FROM (SELECT page_id, coalesce(html, '') AS h, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n,
                 min(page_id) OVER (PARTITION BY coalesce(html, '')) AS f
          FROM pages)
    """,
)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{checkpoint_root(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(table(spark, sf_dir, "pages"), root)
    return warc.read(spark, root, with_payload=False).drop("url")


@query(
    "op6_exact_dedup",
    """
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
    FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256,
                 max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
                 count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size
          FROM documents)
    """,
)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query("op7_license_scan", licenses.oracle())
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op8_suffix_array_dedup")
def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


@query("op9_minhash_near_dedup")
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_groups(table(spark, sf_dir, "documents"), k=4, num=80, den=100)


@query("op10_benchmark_decontamination")
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_LETTERS = r"'[A-Za-z\x{C0}-\x{FF}]+'"
_ASCII_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


@query(
    "op11_importance_resampling",
    f"""
    WITH {sql.CRC_TABLE},
    d AS (SELECT doc_id, regexp_extract_all({sql.lower("text")}, {_ASCII_WORDS}) AS w FROM documents),
    b AS (SELECT unnest(regexp_extract_all({sql.lower("text")}, {_ASCII_WORDS})) AS w FROM benchmark),
    bucket AS (SELECT w, {sql.crc32("w")} % 10000 AS k
               FROM (SELECT w FROM b UNION SELECT unnest(w) FROM d) x, crc_table),
    one AS (SELECT doc_id, k, count(*) AS c FROM (SELECT doc_id, unnest(w) AS w FROM d) x JOIN bucket USING (w) GROUP BY ALL),
    src AS (SELECT k, sum(c) AS s FROM one GROUP BY k),
    tgt AS (SELECT k, count(*) AS t FROM b JOIN bucket USING (w) GROUP BY k),
    tot AS (SELECT (SELECT coalesce(sum(s), 0) FROM src) + 10000 AS ss, (SELECT coalesce(sum(t), 0) FROM tgt) + 10000 AS tt),
    gain AS (SELECT k, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ss::DOUBLE / ((s + 1)::DOUBLE * tt::DOUBLE))) AS BIGINT) AS g
             FROM src LEFT JOIN tgt USING (k), tot),
    weighed AS (SELECT doc_id, CAST(sum(c * g) AS BIGINT) AS weight FROM one JOIN gain USING (k) GROUP BY doc_id),
    noise AS (SELECT doc_id, len(w) AS n_features, CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h FROM d),
    scored AS (SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                 coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
               FROM noise LEFT JOIN weighed USING (doc_id)),
    able AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM scored WHERE n_features >= 20)
    SELECT doc_id, n_features, weight, score,
           CASE WHEN r <= (SELECT count(*) FROM able) * 10 // 100 THEN r END AS rank
    FROM scored LEFT JOIN able USING (doc_id)
    """,
)
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=1)


@query("op12_simhash_near_dedup")
def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@query(
    "op13_spelling_variants",
    f"""
    WITH RECURSIVE {sql.CRC_TABLE},
    one AS (SELECT doc_id, w, count(*) AS c
            FROM (SELECT doc_id, unnest(regexp_extract_all({sql.lower("text")}, {_LETTERS})) AS w FROM documents) x
            WHERE length(w) >= 5 GROUP BY ALL),
    crc AS (SELECT w, c, {sql.crc32("s")} AS h FROM (SELECT w, c, doc_id || ':' || w AS s FROM one) x, crc_table),
    voc AS (SELECT word, CAST(sum(c) AS BIGINT) AS n
            FROM (SELECT c, CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM crc) x
            WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
    cut AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS short
            FROM (SELECT word, unnest(range(0, length(word))) AS i FROM voc) x),
    near AS (SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.short = b.short AND a.i = b.i AND a.word <> b.word
             UNION SELECT a.word, v.word FROM cut a JOIN voc v ON v.word = a.short
             UNION SELECT v.word, a.word FROM cut a JOIN voc v ON v.word = a.short),
    best AS (SELECT word, a.n, count(*) AS n_near, first(near ORDER BY b.n DESC, near) AS top, max(b.n) AS top_n
             FROM near JOIN voc a USING (word) JOIN voc b ON b.word = near GROUP BY word, a.n),
    form AS (SELECT word, top AS form, top_n AS form_n FROM best WHERE top_n >= 2 * n),
    way AS (SELECT word, word AS here FROM voc UNION ALL SELECT way.word, form FROM way JOIN form ON form.word = way.here),
    root AS (SELECT word, here AS root FROM way WHERE here NOT IN (SELECT word FROM form))
    SELECT voc.word, form, root, voc.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, form_n
    FROM voc LEFT JOIN best USING (word) LEFT JOIN form USING (word) JOIN root USING (word)
    """,
)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Build]:
    return {name: q.build for name, q in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.oracle for name, q in QUERIES.items() if q.oracle}
