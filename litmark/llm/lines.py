"""Repeated lines: windows of three lines that occur before, in this or another document, are taken out.

All of it is SQL work: hashes of the windows are grouped with a partial step, later occurrences come from a join on the hash that
adaptive planning can split where a window is frequent, and covered lines are merged per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmark.llm.common import numbered, saved

WINDOW = 3
BLANK = " \\t\\r\\x0b\\f"


def _lines(text: str) -> str:
    return f"split(coalesce({text}, ''), '\\n', -1)"


def windows(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """``row``, ``doc_id``, ``k``, hash (a, b): one row per window of ``width`` neighbouring lines; ``at`` are the lines' places.

    Lines are compared without ASCII white space at their ends; blank lines are passed over. 128 bits keep windows apart.
    """
    source = numbered(docs, "doc_id", F.expr(_lines("text")).alias("lines")).withColumn(
        "solid", F.expr("filter(transform(lines, (x, i) -> struct(regexp_replace(x, '^[\\\\x20\\\\x09-\\\\x0D]+|[\\\\x20\\\\x09-\\\\x0D]+$', '') AS t, i AS i)), s -> s.t <> '')")
    )
    parts = ", ".join(f"solid[k + {j}].t" for j in range(width))
    places = ", ".join(f"solid[k + {j}].i" for j in range(width))
    made = f"transform(sequence(0, size(solid) - {width}), k -> struct(k AS k, xxhash64({parts}) AS a, xxhash64(1, {parts}) AS b, array({places}) AS at))"
    return source.where(F.size("solid") >= width).select("row", "doc_id", F.explode(F.expr(made)).alias("w")).select("row", "doc_id", "w.*")


def dedup_lines(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text): doc_id, n_lines, n_removed, kept (the text that is left), row.

    Of equal windows the first one stays, in the order of doc_id (null before all) and place; rows that repeat a doc_id count in the
    order of the table. Every line that a later window covers is removed, blank lines never. Texts are split at line feeds; a null
    text is the empty text, one blank line. Other columns are ignored; an empty table gives an empty result.
    """
    found = saved(windows(docs, width), "windows")
    order = F.struct("doc_id", "row", "k")
    first = found.groupBy("a", "b").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = found.join(first, ["a", "b"]).where(order > F.col("first"))
    covered = later.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("gone"))
    whole = numbered(docs, "doc_id", "text").join(covered, "row", "left")
    # The one-element inline is a fence: lines are split once, not again for every line that is looked up.
    lines = F.struct(F.expr(_lines("text")).alias("lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    split = whole.select("row", "doc_id", "text", F.inline(F.array(lines)))
    # Places that stay come from one difference of sets, so a text takes time in proportion to its lines.
    left = "array_join(transform(array_except(sequence(0, size(lines) - 1), gone), i -> lines[i]), '\n')"
    return split.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_removed"),
        F.when(F.size("gone") == 0, F.coalesce("text", F.lit(""))).when(F.size("gone") == F.size("lines"), "").otherwise(F.expr(left)).alias("kept"),
        "row",
    )
