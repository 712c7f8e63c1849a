"""Secrets in text: candidates by pattern, false ones sorted out by a random forest. SQL expressions and Spark ML only.

A candidate is a maximal run of at least ``LEAST`` characters of keys and encodings, or a value of any length and characters that an
assignment to a credential's name sets, in quotes or with a digit in it. The forest sees its length, its character classes and the
transitions between them, how much of it a dictionary of frequent words covers, whether it is part of a path, and the words beside it.

It is trained on labelled findings. Where none are given, weak labels stand in: a value that an assignment to a credential's name
sets is a secret; every other finding that does not look like a key itself is not. Unassigned findings of the shape of keys may be either
and are not learned from. As the assignment gives the label, it is hidden from the features of every second secret, so that the
shape has to carry the decision there, and keys in prose are found by it. Scores are the fitted trees written out as SQL conditions.
"""

from __future__ import annotations

from dataclasses import dataclass

from litmark.llm.common import numbered
from litmark.session import scratch_folder
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LEAST = 16
CANDIDATE = r"[A-Za-z0-9_+/=\-]{16,}"
# Characters of context on both sides of a candidate, and matches on either side that hold as many at least.
BESIDE, NEIGHBOURS = 40, 4
#: At most so many distinct labelled findings are fitted on, those with the lowest hash; words of the dictionary, which counts all texts.
LABELLED_ROWS, DICTIONARY_WORDS = 20_000, 300
TREES, DEPTH, SEED, ACCEPTED = 40, 6, 11, 0.5
NAMES = "token|secret|passw(?:or)?d|pwd|api[_-]?key|apikey|access[_-]?key|auth|bearer|credential|private[_-]?key"
SETS = rf"(?i)(?:{NAMES})[A-Za-z0-9_]*[\"']?\s*(?:=>|=|:)\s*"
ASSIGNED = rf"{SETS}[\"']?$"
# An assignment with its value, in quotes on one line or up to white space, and what stands before the value.
VALUE = SETS + r"""(?:"[^"\n]{6,}"|'[^'\n]{6,}'|(?=[^\s"'`,;<>]*[0-9])[^\s"'`,;<>]{6,})"""
NAMED = SETS + r"""["']?"""
# Letters and digits without path separators: what a key without a name looks like.
KEY_SHAPE = "^(?=.*[0-9])(?=.*[A-Za-z])[^/]*$"
FEATURES = [
    "length", "digits", "uppers", "lowers", "hexes", "marks", "classes", "turns", "distinct", "vowels", "covered", "in_path", "after_dot",
    "named_before", "named_after", "assigned", "quoted",
]


def _matches(texts: DataFrame, pattern: str) -> DataFrame:
    """One row per match of ``pattern`` in ``texts`` (row, doc_id, text): its place, and up to ``BESIDE`` characters on either side.

    A text is cut at its matches once. Context is put together from the pieces next to a match, and places are running sums over the
    pieces of a text, so the text itself is not copied to its matches.
    """
    cut = texts.withColumn("all", F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).where(F.size("all") > 0)
    # The one-element inline is a fence: the text is cut once, not again for every match.
    pieces = cut.select("row", "doc_id", F.inline(F.array(F.struct("all", F.split("text", pattern, -1).alias("gaps")))))

    def piece(array: str, place: Column, side: str) -> Column:
        text = F.coalesce(F.get(array, place), F.lit(""))
        return F.right(text, F.lit(BESIDE)) if side == "end" else F.left(text, F.lit(BESIDE))

    def one(i: Column) -> Column:
        before, after = [piece("gaps", i, "end")], [piece("gaps", i + 1, "start")]
        for k in range(1, NEIGHBOURS + 1):
            before = [piece("gaps", i - k, "end"), piece("all", i - k, "end"), *before]
            after += [piece("all", i + k, "start"), piece("gaps", i + k + 1, "start")]
        return F.struct(
            i.alias("i"),
            F.get("all", i).alias("match"),
            F.length(F.get("gaps", i)).alias("gap"),
            F.right(F.concat(*before), F.lit(BESIDE)).alias("before"),
            F.left(F.concat(*after), F.lit(BESIDE)).alias("after"),
        )

    found = pieces.select("row", "doc_id", F.inline(F.transform(F.sequence(F.lit(0), F.size("all") - 1), one)))
    earlier = Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.coalesce(F.sum(F.col("gap") + F.length("match")).over(earlier), F.lit(0))
    return found.select("row", "doc_id", "match", (passed + F.col("gap")).cast("long").alias("start"), "before", "after")


def findings(docs: DataFrame) -> DataFrame:
    """One row per distinct candidate of a document: row, doc_id, finding, start (from 0, its first place), times, before, after."""
    texts = numbered(docs, "doc_id", "text").where("text IS NOT NULL")
    runs = _matches(texts, CANDIDATE).withColumnRenamed("match", "finding")
    head = F.regexp_extract("match", NAMED, 0)
    ends = F.when(head.rlike("[\"']$"), 1).otherwise(0)
    value = F.substring("match", F.length(head) + 1, F.length("match") - F.length(head) - ends)
    values = _matches(texts, VALUE).select(
        "row",
        "doc_id",
        value.alias("finding"),
        (F.col("start") + F.length(head)).alias("start"),
        F.right(F.concat("before", head), F.lit(BESIDE)).alias("before"),
        F.left(F.concat(F.right("match", ends), "after"), F.lit(BESIDE)).alias("after"),
    )
    # Values that hold a long run are found by it.
    every = runs.unionByName(values.where(~F.col("finding").rlike(CANDIDATE)))
    first = F.min_by(F.struct("before", "after"), "start")
    grouped = every.groupBy("row", "doc_id", "finding").agg(F.min("start").alias("start"), F.count("*").alias("times"), first.alias("beside"))
    return grouped.select("row", "doc_id", "finding", "start", "times", "beside.before", "beside.after")


def dictionary(docs: DataFrame) -> list[str]:
    """The most frequent words of three to nine letters, in lower case, of all texts in all scripts; longest first."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(?<!\p{L})\p{L}{3,9}(?!\p{L})"), F.lit(0))).alias("word"))
    top = words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(DICTIONARY_WORDS)
    return sorted((r.word for r in top.collect()), key=lambda w: (-len(w), w))


def _share(pattern: str):
    return (F.length("finding") - F.length(F.regexp_replace("finding", pattern, ""))) / F.length("finding")


def with_features(found: DataFrame, words: list[str]) -> DataFrame:
    """The findings with one double column for each of ``FEATURES``."""
    shape = F.col("finding")
    for pattern, sign in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "0"), ("[^a-zA-Z0-9]+", "-")):
        shape = F.regexp_replace(shape, pattern, sign)
    left = F.regexp_replace(F.lower("finding"), "|".join(words), "") if words else F.lower("finding")
    columns = {
        "length": F.least(F.length("finding"), F.lit(400)),
        "digits": _share("[0-9]"),
        "uppers": _share("[A-Z]"),
        "lowers": _share("[a-z]"),
        "hexes": _share("[0-9a-fA-F]"),
        "marks": _share("[^a-zA-Z0-9]"),
        "classes": F.size(F.array_distinct(F.split(shape, ""))),
        "turns": (F.length(shape) - 1) / F.length("finding"),
        "distinct": F.size(F.array_distinct(F.split("finding", ""))) / F.least(F.length("finding"), F.lit(64)),
        "vowels": _share("[aeiouAEIOU]"),
        "covered": 1 - F.length(left) / F.length("finding"),
        "in_path": F.col("finding").rlike("^/|/.*/") | F.col("before").rlike(r"[/\\\\.][A-Za-z0-9_.\\-]*$|https?:"),
        "after_dot": F.col("before").rlike(r"[.!?]\s+$|^$"),
        "named_before": F.col("before").rlike(f"(?i){NAMES}"),
        "named_after": F.col("after").rlike(f"(?i){NAMES}"),
        "assigned": F.col("before").rlike(r"[=:]\s*[\"']?$"),
        "quoted": F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']"),
    }
    return found.select("*", *[columns[name].cast("double").alias(name) for name in FEATURES])


def _trees(spark: SparkSession, model) -> list[Column]:
    """The probability of label 1 by each tree of a fitted forest, read from the table that the model is saved as."""
    folder = scratch_folder(spark, "forest")
    model.save(folder)
    nodes: dict[int, dict] = {}
    for r in spark.read.parquet(f"{folder}/data").collect():
        nodes.setdefault(r.treeID, {})[r.nodeData.id] = r.nodeData

    def below(tree: dict, place: int) -> Column:
        node = tree[place]
        if node.leftChild < 0:
            return F.lit(node.impurityStats[1] / sum(node.impurityStats))
        test = F.col(FEATURES[node.split.featureIndex]) <= float(node.split.leftCategoriesOrThreshold[0])
        return F.when(test, below(tree, node.leftChild)).otherwise(below(tree, node.rightChild))

    return [below(tree, 0) for _, tree in sorted(nodes.items())]


@dataclass(frozen=True)
class Scanner:
    """A fitted scanner: ``score`` of a row with features. Without findings of both kinds to learn from, every score is the same."""

    words: list[str]
    score: Column

    def scan(self, docs: DataFrame) -> DataFrame:
        """One row per distinct candidate of a document: doc_id, finding, start, times, score, secret.

        Texts that are null, empty or hold no candidate give no row; repeated rows give their findings each. Other columns are
        ignored.
        """
        scored = with_features(findings(docs), self.words).withColumn("score", self.score)
        return scored.select("doc_id", "finding", "start", "times", "score", (F.col("score") >= ACCEPTED).alias("secret"))


def weakly_labelled(found: DataFrame) -> DataFrame:
    """Findings with ``label`` 1 for assigned values and 0 for others that have no key's shape; the rest is left out.

    The assignment of every second secret, by its hash, is cut from ``before``.
    """
    assigned = F.col("before").rlike(ASSIGNED)
    hidden = assigned & (F.pmod(F.xxhash64("finding"), F.lit(2)) == 0)
    return found.where(assigned | ~F.col("finding").rlike(KEY_SHAPE)).select(
        "finding",
        F.when(hidden, F.regexp_replace("before", ASSIGNED, "")).otherwise(F.col("before")).alias("before"),
        F.when(hidden, F.regexp_replace("after", "^[\"']", "")).otherwise(F.col("after")).alias("after"),
        assigned.cast("double").alias("label"),
    )


def learn(docs: DataFrame, labelled: DataFrame | None = None) -> Scanner:
    """A scanner from ``labelled`` findings (finding, before, after, label 0 or 1), or from those of ``docs`` with weak labels."""
    spark = docs.sparkSession
    labelled = weakly_labelled(findings(docs)) if labelled is None else labelled
    columns = [F.coalesce(c, F.lit("")).alias(c) for c in ("before", "after")]
    order = F.xxhash64("finding", "before", "after")
    # One task sees the bounded sample of distinct findings, in a fixed order, so the forest is the same in every run.
    sample = (
        labelled.where("finding IS NOT NULL AND label IS NOT NULL")
        .select("finding", *columns, F.col("label").cast("double").alias("label"))
        .distinct()
        .orderBy(order, "finding", "before", "after", "label")
        .limit(LABELLED_ROWS)
    )
    words = dictionary(docs)
    rows = with_features(sample, words).coalesce(1).persist()
    try:
        kinds = sorted(r.label for r in rows.select("label").distinct().collect())
        if len(kinds) < 2:
            return Scanner(words, F.lit(float(kinds[0]) if kinds else 0.0))
        assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label")
        trees = _trees(spark, forest.fit(assembler.transform(rows)))
        return Scanner(words, sum(trees, F.lit(0.0)) / len(trees))
    finally:
        rows.unpersist()


def scan(docs: DataFrame) -> DataFrame:
    """Findings of ``docs`` (doc_id, text) by a scanner that is fitted on the findings of the same documents."""
    return learn(docs).scan(docs)
