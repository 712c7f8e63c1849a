"""The registered queries of the text operators, each with production parameters over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from litmark.llm import quality
from litmark.llm.alignment import link_counts
from litmark.llm.common import documents
from litmark.llm.exact import exact_groups
from litmark.llm.language import language
from litmark.llm.language import learn as learn_language
from litmark.llm.leaks import with_leaks
from litmark.llm.lines import dedup_lines
from litmark.llm.packing import pack
from litmark.llm.personal import find as find_personal
from litmark.llm.secrets import scan
from litmark.llm.simhash import near_duplicates
from litmark.llm.suffixes import remove_repeats
from litmark.llm.tokens import token_counts
from litmark.llm.whitening import whiten
from litmark.session import apply_settings
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function as the query of its own name. Texts travel to Python in batches of at most 1,000 rows."""

    def register(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            apply_settings(spark)
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
            return function(spark, folder)

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


EXACT_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
  sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)
"""


@query(EXACT_SQL)
def op4_exact(spark, folder):
    return exact_groups(documents(spark, folder)).drop("row")


def held_out(modulus: int, rest: int):
    """Rows whose labels are not learned from; a row without an id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == rest, F.lit(False))


@query()
def op6_quality(spark, folder):
    docs = documents(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(~held_out(4, 2))
    trees = quality.learn(docs, labels)
    return docs.select("doc_id", held_out(4, 2).alias("held_out"), quality.score(trees, F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= quality.ACCEPTED).cast("int")
    )


@query()
def op9_simhash(spark, folder):
    return near_duplicates(documents(spark, folder)).select("doc_id", "fingerprint", "component_id")


@query()
def op3_packing(spark, folder):
    return pack(documents(spark, folder))


@query()
def op10_tokens(spark, folder):
    docs = documents(spark, folder)
    counts = token_counts(spark, F.col("text")).alias("counts")
    return docs.select("doc_id", counts).select(
        "doc_id", "counts.n_bytes", "counts.n_tokens", (F.col("counts.n_tokens") > 512).alias("over_limit")
    )


@query()
def op8_leaks(spark, folder):
    """One row per document and benchmark item that it holds."""
    found = with_leaks(documents(spark, folder).select("doc_id", "text"), spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@query()
def pipeline(spark, folder):
    from corpus_pipeline import run

    return run(spark, folder)


LINES_SQL = r"""
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
s AS (SELECT doc_id, unnest(generate_series(1, len(lines))) AS i, unnest(lines) AS line FROM l),
t AS (SELECT doc_id, i, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS t FROM s),
w AS (SELECT doc_id, i, lead(i) OVER d AS j, lead(i, 2) OVER d AS k, [t, lead(t) OVER d, lead(t, 2) OVER d] AS w
  FROM t WHERE t <> '' WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS nth FROM w WHERE k IS NOT NULL),
g AS (SELECT DISTINCT doc_id, unnest([i, j, k]) AS i FROM f WHERE nth > 1)
SELECT s.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
  sha256(coalesce(string_agg(s.line, chr(10) ORDER BY s.i) FILTER (WHERE g.i IS NULL), '')) AS kept_sha256
FROM s LEFT JOIN g ON s.doc_id = g.doc_id AND s.i = g.i GROUP BY s.doc_id
"""


@query(LINES_SQL)
def op2_lines(spark, folder):
    found = dedup_lines(documents(spark, folder))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op5_language(spark, folder):
    docs = documents(spark, folder)
    model = learn_language(docs.where(~held_out(5, 0)))
    found = language(model, F.col("text")).alias("found")
    return docs.select("doc_id", held_out(5, 0).alias("held_out"), found).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )


@query()
def op7_secrets(spark, folder):
    return scan(documents(spark, folder))


@query()
def op1_suffixes(spark, folder):
    return remove_repeats(documents(spark, folder)).drop("row")


@query()
def op13_whitening(spark, folder):
    """One row per vector and component, by falling variance."""
    rows, fit, error = whiten(spark.read.parquet(f"{folder}/embeddings.parquet"))
    shares = [v / fit.trace for v in fit.values.tolist()] if fit else []
    n = fit.n if fit else 0
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.lit(shares).cast("array<double>"), "place").alias("explained"),
        F.lit(error).alias("identity_error"),
    )


@query()
def op11_personal(spark, folder):
    """Base spans counted by kind, and all spans by kind and start."""

    def joined(base: bool):
        spans = F.filter("spans", lambda s: s.base) if base else F.col("spans")
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s.base & (s.kind == kind))).cast("long").alias(f"n_{kind}")

    found = documents(spark, folder).select("doc_id", find_personal(F.col("text")).alias("spans"))
    return found.select(
        "doc_id", *[count(k) for k in ("email", "ip", "card", "phone")], F.sha2(joined(True), 256).alias("base_sha256"), joined(False).alias("spans")
    )


@query()
def op12_alignment(spark, folder):
    return link_counts(documents(spark, folder)).drop("row")
