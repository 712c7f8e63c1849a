import numpy as np
import pyarrow as pa
import pytest
from litmark.llm import quality
from pyspark.sql import functions as F

from .conftest import CLASHING

FOLDER = "/root/testdata/sf0.01"


def test_statistics_do_not_depend_on_the_batch():
    texts = ["", None, "One line.\nOne line.\nAnother", "A!! B!!", "x " * 300_000, "é", "\n", "  "]
    whole = quality.statistics(pa.array(texts, pa.string()))
    alone = np.concatenate([quality.statistics(pa.array([t], pa.string())) for t in texts])
    assert whole.shape == (len(texts), quality.WIDTH)
    np.testing.assert_allclose(whole, alone)
    assert not whole[:2].any()


def test_flat_trees_agree_with_a_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    trees = quality.grow(x, y)

    def walk(row):
        total = trees.start
        for feature, cut, leaf in zip(trees.feature, trees.cut, trees.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))

    np.testing.assert_allclose(trees.score(x), [walk(r) for r in x])
    assert ((trees.score(x) > 0.5) == (y > 0)).mean() > 0.97


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, None, 0), (None, 1, 0)]])
def test_too_few_labels(spark, table, labels):
    docs = table([(1, "a b"), (2, None), (None, ""), (2, "again")], CLASHING)
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scores = [r.s for r in docs.select(quality.score(quality.learn(docs, given), F.col("text")).alias("s")).collect()]
    assert len(scores) == 4 and all(0 <= s <= 1 for s in scores)
    kept = quality.drop_poor(docs, given)
    assert kept.schema == docs.schema


def test_repeated_ids_are_reduced_before_they_are_collected(spark, table, monkeypatch):
    texts = [f"text {k} " * (k + 1) for k in range(40)]
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    collected, fitted = [], []
    plain, grow = type(labels).toPandas, quality.grow

    def counted(frame):
        rows = plain(frame)
        collected.append(len(rows))
        return rows

    monkeypatch.setattr(type(labels), "toPandas", counted)
    monkeypatch.setattr(quality, "grow", lambda x, y: fitted.append((x.tolist(), y.tolist())) or grow(x, y))
    for order in (texts, texts[::-1]):
        quality.learn(table([(1, t) for t in order] + [(2, "other")] * 3), labels)
    assert collected == [2, 2]
    assert fitted[0] == fitted[1]


def test_empty_table(spark, table):
    docs = table([])
    assert quality.drop_poor(docs, spark.createDataFrame([], "doc_id long, quality int")).count() == 0


def test_held_out_accuracy(spark):
    from litmark.llm.queries import QUERIES

    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = QUERIES["op6_quality"](spark, FOLDER).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
