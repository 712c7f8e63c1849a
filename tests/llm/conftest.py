import pytest
from pyspark.sql import types as T

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


@pytest.fixture
def table(spark, tmp_path):
    """Documents from (doc_id, text) pairs, written and read as a table, with extra columns of clashing names."""
    made = []

    def make(rows, extra=()):
        path = str(tmp_path / f"docs{len(made)}")
        made.append(path)
        schema = T._parse_datatype_string(SCHEMA + "".join(f", {c} string" for c in extra))
        full = [(i, t, None, "s", None if t is None else len(t), *["x"] * len(extra)) for i, t in rows]
        spark.createDataFrame(full, schema).repartition(3).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    return make


CLASHING = ("row", "doc", "keep", "size", "score", "part", "group", "a", "b", "n", "key", "node", "root", "start")
