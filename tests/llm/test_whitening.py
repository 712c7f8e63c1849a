import numpy as np
import pytest
from litmark.llm import whitening

NAN, INF = float("nan"), float("inf")


def plain(vectors, counted=False):
    """Whitened rows in double precision, over distinct vectors, written down directly."""
    x = np.floor(64 * np.array(vectors)).astype(np.int64) + 1_000_000
    distinct, counts = np.unique(x, axis=0, return_counts=True)
    weight = counts if counted else np.ones(len(distinct), np.int64)
    n, total = int(weight.sum()), (distinct * weight[:, None]).sum(0)
    centred = (n * distinct - total) / n
    values, axes = np.linalg.eigh(centred.T @ (centred * weight[:, None]) / n)
    order = np.argsort(-values)
    own = (n * x - total) / n
    deviations = [sum(int(v) ** 2 for v in row) for row in (n * x - total).tolist()]
    return n, deviations, values[order], own @ axes[:, order] / np.sqrt(np.abs(values[order]) + 1e-300), values.sum()


def embeddings(spark, tmp_path, rows, extra=""):
    path = str(tmp_path / "vectors")
    schema = "vec_id long, embedding array<float>, label int" + extra
    spark.createDataFrame([(*r, 0, *["x"] * extra.count(",")) for r in rows], schema).repartition(3).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@pytest.mark.parametrize("counted", [False, True])
def test_as_written_down_directly(spark, tmp_path, counted):
    rng = np.random.default_rng(5)
    base = (rng.normal(size=(120, 6)) @ rng.normal(size=(6, 6))).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(base)] + [(900 + i, base[7]) for i in range(60)] + [(None, base[3]), (5, base[5])]
    bad = [(2000, None), (2001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2002, [NAN] * 6), (2003, [0.0, 0.0, INF, 0.0, 0.0, 0.0]), (2004, [0.0, -INF, 0.0, 0.0, 0.0, 0.0])]
    odd = [(3000, [1.0, 2.0]), (3001, [])]
    frame, fit, error = whitening.whiten(embeddings(spark, tmp_path, rows + bad + odd, ", x string, `a.b` string, key string, rows string"), counted=counted)
    found = sorted(((r.vec_id, r.deviation, r.whitened) for r in frame.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    n, deviations, values, whitened, trace = plain([v for _, v in rows], counted)
    wanted = sorted(((i, d, w) for (i, _), d, w in zip(rows, deviations, whitened, strict=True)), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [r[:2] for r in found] == [r[:2] for r in wanted]
    assert fit.n == n and np.allclose(fit.values, values) and np.isclose(fit.trace, trace)
    assert np.allclose(np.abs([r[2] for r in found]), np.abs([r[2] for r in wanted]), atol=1e-8)
    assert error < 1e-9


def test_lower_rank_constant_and_empty(spark, tmp_path):
    rows = [(i, [float(i), 2.0 * i, 5.0, 1e30]) for i in range(9)]
    frame, fit, error = whitening.whiten(embeddings(spark, tmp_path, rows))
    assert len(fit.values) == 1 and error < 1e-9 and frame.count() == 9
    empty = whitening.whiten(embeddings(spark, tmp_path / "empty", [(1, None)]))[0]
    assert empty.columns == ["vec_id", "deviation", "whitened"] and empty.collect() == []
    same = whitening.whiten(embeddings(spark, tmp_path / "same", [(1, [1.0, 2.0]), (2, [1.0, 2.0])]))[0].collect()
    assert [(r.deviation, r.whitened) for r in same] == [(0, []), (0, [])]
    none = whitening.whiten(embeddings(spark, tmp_path / "none", [(1, []), (2, [])]))[0].collect()
    assert [(r.deviation, r.whitened) for r in none] == [(0, []), (0, [])]


def test_deviations_beyond_a_long_are_null_and_others_exact():
    fit = whitening.Fit(3, [3_000_001, 3], np.ones(1), np.ones((2, 1)), 1.0)
    x = np.array([[1_000_000, 1], [1_000_000_000, 7], [1 << 40, 1]])
    assert fit.deviations(x) == [1, (3 * 1_000_000_000 - 3_000_001) ** 2 + 18**2, None]


def test_query_over_the_table(spark):
    from litmark.llm.queries import QUERIES

    found = QUERIES["op13_whitening"](spark, "/root/testdata/sf0.01").toPandas()
    source = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").toPandas()
    n, deviations, values, whitened, trace = plain(np.array(source.embedding.tolist(), float))
    place = {v: k for k, v in enumerate(source.vec_id)}
    rows, component = found.vec_id.map(place).to_numpy(), found.component.to_numpy() - 1
    assert len(found) == 16 * len(source) and set(found.n) == {n}
    assert found.deviation.tolist() == [deviations[k] for k in rows]
    assert np.allclose(np.abs(found.whitened), np.abs(whitened[rows, component]), atol=1e-8)
    assert np.allclose(found.explained, values[component] / trace) and found.identity_error.max() < 1e-9
