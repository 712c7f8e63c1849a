"""Runs that fail or die at every step leave the old state or the new one, never a mixture."""

import pytest
from litmark.sources import catalog, commits, publish
from litmark.sources import snapshots as S
from pyspark.sql import functions as F


class Killed(BaseException):
    """Stands for a process that ends: no handler of the code under test is meant to see it."""


def killed(*_, **__):
    raise Killed


def yearly(spark, value):
    return spark.range(60).select((F.col("id") % 3 + 2022).cast("int").alias("ano"), F.lit(value).alias("v"))


def values(spark, path):
    return {(r["ano"], r["v"]) for r in S.read_latest_per(spark, path).distinct().collect()}


def test_commits_are_numbered_and_refuse_a_second_writer(spark, tmp_path):
    path = str(tmp_path / "t")
    assert commits.last_commit(spark, path) == (0, {})
    assert commits.commit(spark, path, 0, {"a": 1}) == 1
    with pytest.raises(commits.CommitConflictError):
        commits.commit(spark, path, 0, {"a": 2})
    assert commits.last_commit(spark, path) == (1, {"a": 1, "retired": []})
    for number in range(1, 30):
        commits.commit(spark, path, number, {"a": number})
    assert len(publish.child_names(spark, f"{path}/_commits")) == commits.KEPT


def test_retired_folders_wait_for_their_grace(spark, tmp_path):
    path = str(tmp_path / "t")
    (tmp_path / "t" / "old").mkdir(parents=True)
    commits.commit(spark, path, 0, {}, ["old"], grace=2)
    commits.commit(spark, path, 1, commits.last_commit(spark, path)[1], grace=2)
    assert "old" in publish.child_names(spark, path)
    commits.commit(spark, path, 2, commits.last_commit(spark, path)[1], grace=2)
    assert "old" not in publish.child_names(spark, path)


@pytest.mark.parametrize("step", ["reconcile", "commit"])
def test_a_snapshot_that_dies_before_its_commit(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    S.write_snapshot(spark.range(5), path, "2026-01-01")
    S.write_yearly_snapshot(yearly(spark, 1), f"{path}/anos", "2026-01-01")
    with monkeypatch.context() as m:
        m.setattr(S, step, killed)
        for write in (lambda: S.write_snapshot(spark.range(9), path, "2026-01-01"), lambda: S.write_yearly_snapshot(yearly(spark, 2), f"{path}/anos", "2026-01-01")):
            with pytest.raises(Killed):
                write()
    assert S.read_latest(spark, path).count() == 5
    assert values(spark, f"{path}/anos") == {(2022, 1), (2023, 1), (2024, 1)}
    # The next run clears away what the dead one left.
    S.write_snapshot(spark.range(7), path, "2026-01-01")
    S.write_yearly_snapshot(yearly(spark, 3), f"{path}/anos", "2026-01-01")
    assert S.read_latest(spark, path).count() == 7 == S.read_by_name(spark, f"{path}/data_ingestao=2026-01-01").count()
    assert values(spark, f"{path}/anos") == {(2022, 3), (2023, 3), (2024, 3)}
    assert all(len(publish.child_names(spark, f"{path}/anos/ano={y}/data_ingestao=2026-01-01")) == 1 for y in (2022, 2023, 2024))


def test_a_snapshot_that_dies_after_its_commit(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    S.write_yearly_snapshot(yearly(spark, 1), path, "2026-01-01")
    with monkeypatch.context() as m:
        m.setattr(commits, "remove_folder", killed)
        with pytest.raises(Killed):
            S.write_yearly_snapshot(yearly(spark, 2), path, "2026-01-01")
    assert values(spark, path) == {(2022, 2), (2023, 2), (2024, 2)}


def test_a_failure_in_one_year_leaves_all_years(spark, tmp_path):
    path = str(tmp_path / "t")
    S.write_yearly_snapshot(yearly(spark, 1), path, "2026-01-01")
    broken = yearly(spark, 2).withColumn("v", F.when(F.col("ano") == 2023, F.raise_error(F.lit("boom")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="boom"):
        S.write_yearly_snapshot(broken, path, "2026-01-01")
    assert values(spark, path) == {(2022, 1), (2023, 1), (2024, 1)}


def test_folders_of_other_programs_are_found_and_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4).write.parquet(f"{path}/data_ingestao=2026-03-01")
    S.write_snapshot(spark.range(5), path, "2026-02-01")
    assert S.read_latest(spark, path).count() == 4
    S.write_snapshot(spark.range(6), path, "2026-03-01")
    assert S.read_latest(spark, path).count() == 6 and S.latest_snapshot(spark, path, S.BRONZE_DATE) == "2026-03-01"
    for year in (2023, 2024):
        spark.createDataFrame([(1,)], "v int").write.parquet(f"{path}/anos/ano={year}/data_ingestao=2026-01-01")
    S.write_yearly_snapshot(spark.createDataFrame([(2024, 2)], "ano int, v int"), f"{path}/anos", "2026-01-02")
    assert values(spark, f"{path}/anos") == {(2023, 1), (2024, 2)}


@pytest.fixture
def database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE commit_test LOCATION '{tmp_path}/db'")
    yield "commit_test"
    spark.sql("DROP DATABASE commit_test CASCADE")


@pytest.mark.parametrize("partitioning", [None, ["ano"]])
def test_a_load_that_dies(spark, database, monkeypatch, partitioning):
    table = f"{database}.t"
    for rows, step, found in ((10, None, 10), (20, "reconcile", 10), (30, "commit", 10), (40, "point_table", 40), (50, "describe_table", 50)):
        df = spark.range(rows).select((F.col("id") % 2).cast("int").alias("ano"), "id")
        with monkeypatch.context() as m:
            if step:
                m.setattr(catalog, step, killed)
                with pytest.raises(Killed):
                    catalog.load_table(df, table, ["id"], partitioning)
            else:
                catalog.load_table(df, table, ["id"], partitioning)
        assert catalog.read_committed(spark, table).count() == found
        if step == "point_table":
            assert spark.table(table).count() == 10  # the folder shown so far stays until the next load
            assert catalog.restore_tables(spark, database) == ["t"]
        assert spark.table(table).count() == found
    assert catalog._metadata(spark, table)["type"] == "MANAGED"


def test_a_lost_or_half_made_table_is_restored(spark, database, monkeypatch):
    table = f"{database}.t"
    catalog.load_table(spark.range(10), table)
    steps = iter([catalog._files, killed])
    with monkeypatch.context() as m:  # other columns: dies when the old table is gone and the empty one is to be made
        m.setattr(catalog, "_files", lambda rows, parts: next(steps)(rows, parts))
        with pytest.raises(Killed):
            catalog.load_table(spark.range(20).withColumn("b", F.lit("x")), table)
    assert not spark.catalog.tableExists(table) and catalog.read_committed(spark, table).count() == 20
    catalog.restore_tables(spark, database)
    assert spark.table(table).columns == ["id", "b"] and spark.table(table).count() == 20
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{catalog._home(spark, table)}/_none'")
    spark.sql(f"DROP TABLE {table}")
    catalog.restore_tables(spark, database)
    assert spark.table(table).count() == 20
    catalog.load_table(spark.range(3), table)
    assert spark.table(table).columns == ["id"] and spark.table(table).count() == 3


def test_a_clustered_load_runs_its_source_once(spark, database):
    counted = spark.sparkContext.accumulator(0)

    def see(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).mapInArrow(see, "id long")
    assert catalog.load_table(rows, f"{database}.once", ["id"]) == 1000
    assert counted.value == 1000


def test_a_raised_move_brings_the_old_folder_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    real = publish.filesystem

    class Files:
        """A file system whose second move raises."""

        def __init__(self, files):
            self.files, self.moves = files, 0

        def __getattr__(self, name):
            return getattr(self.files, name)

        def rename(self, a, b):
            self.moves += 1
            if self.moves == 2:
                raise OSError("lost")
            return self.files.rename(a, b)

    made = Files(real(spark, path)[0])
    monkeypatch.setattr(publish, "filesystem", lambda s, p: (made, real(s, p)[1]))
    spark.range(9).write.parquet(f"{path}-new")
    with pytest.raises(OSError, match="lost"):
        publish.put_in_place(spark, f"{path}-new", path)
    assert spark.read.parquet(path).count() == 3


def test_the_inventory_reads_no_data(spark, database):
    catalog.load_table(spark.range(1000).withColumn("ano", (F.col("id") % 3).cast("int")), f"{database}.a", ["id"], ["ano"])
    spark.range(10).write.saveAsTable(f"{database}.b")
    made = catalog.inventory(spark, [database])
    found = {r["tabela"]: (r["linhas"], r["bytes_totais"] > 0, r["particionada"]) for r in made.collect()}
    assert found["a"] == (1000, True, True) and found["b"][0] == 0 and not made.inputFiles()
    catalog.refresh_statistics(spark, database)
    assert {r["tabela"]: r["linhas"] for r in catalog.inventory(spark, [database]).collect()} == {"a": 1000, "b": 10}
    stored = catalog._metadata(spark, f"{database}.a").get("statistics") or {}
    assert "num_rows" not in stored  # the loaded table was not read for it
