from itertools import combinations

import numpy as np
import pyarrow as pa
from litmark.llm import language
from litmark.llm.queries import QUERIES
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .conftest import CLASHING, SCHEMA

PATH = language.vocabulary_file()


def test_forward_sums_all_segmentations():
    known = language.vocabulary(PATH)
    table = np.random.default_rng(2).random((len(known) + 1, 3)) / 50
    for word in ("hello", "straße", "ñandú", "中中a", "x"):
        part = language.BEGIN + word
        total = np.zeros(3)
        for k in range(len(part)):
            for cuts in combinations(range(1, len(part)), k):
                places = [0, *cuts, len(part)]
                pieces = [part[a:b] for a, b in zip(places[:-1], places[1:], strict=True)]
                if all(p in known or len(p) == 1 for p in pieces):
                    total += np.prod([table[known.get(p, 0)] for p in pieces], axis=0)
        np.testing.assert_allclose(np.exp(language.word_scores(PATH, ["other", word, word], table))[1], total)


def test_long_words_and_batches_agree():
    rng = np.random.default_rng(2)
    table = rng.random((len(language.vocabulary(PATH)) + 1, 2)) / 1000
    model = language.Model("test", PATH, ["x", "y"], table, np.log([0.5, 0.5]))
    texts = ["a" * 50_000, "one two", None, "", "12 !?", "one two three " * 5000]
    labels, score = model.predict(pa.array(texts))
    assert labels[2:5] == ["und"] * 3 and not score[2:5].any()
    assert all(0 <= s <= 1 for s in score)
    alone = [model.predict(pa.array([t], pa.string())) for t in texts]
    assert labels == [a[0][0] for a in alone]


def frame(spark, rows, extra=()):
    schema = T._parse_datatype_string(SCHEMA + "".join(f", {c} string" for c in extra))
    return spark.createDataFrame([(i, t, lang, "s", 1, *["x"] * len(extra)) for i, t, lang in rows], schema)


def test_learn_and_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (2, "der hund und die katze", "de"), (3, None, "fr"), (4, "text", None), (None, "no id", "en"), (5, "", "es")]
    docs = frame(spark, rows, CLASHING)
    model = language.learn(docs)
    assert model.languages == ["de", "en"]
    made = docs.select("doc_id", language.language(model, F.col("text")).alias("l")).collect()
    assert [(r.doc_id, r.l.lang) for r in made][:2] == [(1, "en"), (2, "de")]
    empty = language.learn(frame(spark, []))
    assert {r.l.lang for r in docs.select(language.language(empty, F.col("text")).alias("l")).collect()} == {"und"}


def test_prior_counts_documents_beyond_the_bound(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(9)] + [(i, "der hund und die katze", "de") for i in range(20, 23)]
    model = language.learn(frame(spark, rows + rows[:1] * 5), bound=2)
    assert model.languages == ["de", "en"]
    np.testing.assert_allclose(np.exp(model.prior), [3 / 12, 9 / 12])


def test_many_languages(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(4)] + [(i, "der hund und die katze", "de") for i in range(10, 13)]
    rows += [(20 + i, f"un mot rare{i}", f"x{i:03}") for i in range(40)]
    model = language.learn(frame(spark, rows), most=3)
    assert model.languages == ["de", "en", "x000"]
    assert model.table.shape[1] == 3
    np.testing.assert_allclose(np.exp(model.prior), [3 / 8, 4 / 8, 1 / 8])


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op5_language"](spark, folder).where("held_out").join(docs, "doc_id").collect()
    assert len(rows) > 100
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97
