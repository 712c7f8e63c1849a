from litmark.llm import common


def test_rows_keep_their_numbers_when_cores_change(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50_000).selectExpr("id", "repeat(md5(cast(id AS string)), 20) AS text").repartition(2).write.parquet(path)
    spark.conf.unset(common.SPLITS)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        first = common.numbered(spark.read.parquet(path), "id")
        assert spark.conf.get(common.SPLITS) == str(spark.sparkContext.defaultParallelism)
        second = common.numbered(spark.read.parquet(path), "id", "text").drop("text")
        assert first.rdd.getNumPartitions() > 2
        assert first.exceptAll(second).isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_columns_with_dots(table):
    from litmark.llm import exact, leaks, simhash

    docs = table([(1, "one two three"), (2, "one two three"), (3, None)], ("`a.b`",))
    for kept in (exact.drop_exact(docs), simhash.drop_near(docs), leaks.drop_leaks(docs, docs.sparkSession.createDataFrame([], "item_id long, text string"))):
        assert kept.schema == docs.schema and kept.count() in (2, 3)
