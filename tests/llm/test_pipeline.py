import re

import corpus_pipeline
import pytest
from litmark.llm.common import saved

from .test_simhash import plain_print, plain_roots

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    made = [docs]
    for name, stage in corpus_pipeline.STAGES:
        made.append(saved(stage(spark, made[-1], FOLDER), name))
    return made


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_columns_and_size(steps):
    for frame in steps[1:5]:
        assert frame.columns == steps[0].columns
    assert all(0 < b.count() <= a.count() for a, b in zip(steps[:4], steps[1:5], strict=True))


def test_clean_documents_stay(spark, steps):
    good = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()}
    assert len(good - set(ids(steps[1]))) <= 0.02 * len(good)


def test_exact_stage(steps):
    groups = {}
    for r in steps[1].collect():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), []).append(r.doc_id)
    assert ids(steps[2]) == sorted(min(g) for g in groups.values())


def test_near_stage(steps):
    rows = sorted(steps[2].collect(), key=lambda r: r.doc_id)
    roots = plain_roots([plain_print(r.text) for r in rows])
    assert ids(steps[3]) == sorted({rows[k].doc_id for k in roots})


def test_leak_stage(spark, steps):
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    left = {r.doc_id: r.text for r in steps[4].collect()}
    assert not [i for i, t in left.items() if any(x in t for x in items)]
    held = {r.doc_id for r in steps[3].collect() if any(x[:60] in r.text for x in items)}
    assert set(ids(steps[3])) - set(left) <= held


def test_packing_stage(steps):
    assert sorted({r.doc_id for r in steps[5].collect()}) == ids(steps[4])


def test_run(spark, steps):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ours = sorted(tuple(r) for r in corpus_pipeline.run(spark, FOLDER).select(columns).collect())
    assert ours == sorted(tuple(r) for r in steps[5].select(columns).collect())
