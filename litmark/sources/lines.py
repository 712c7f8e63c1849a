"""Line files: JSON lines with file name and line number, strict JSON, row counts by file type."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litmark.functions.text import strip

# One row per line: where it stands and what it says.
LINE_COLUMNS = ["arquivo", "arquivo_origem", "bloco", "value"]


def scan_lines(reader, path: str, glob: str | None = None) -> DataFrame:
    """Lines of all files below ``path``; ``reader`` is ``spark.read`` or ``spark.readStream``.

    ``bloco`` is the offset of the file split the line came from.
    """
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return (
        reader.format("text")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            F.col("_metadata.file_path").alias("arquivo"),
            F.col("_metadata.file_name").alias("arquivo_origem"),
            F.col("_metadata.file_block_start").alias("bloco"),
            "value",
        )
    )


def mark_positions(lines: DataFrame) -> DataFrame:
    """Adds ``posicao``, which grows by one from line to line of a split.

    ``number_lines`` uses the result twice: ``lines`` must be a scan of files, which gives the same splits each time, or persisted.
    """
    return lines.withColumn("posicao", F.monotonically_increasing_id())


#: Scans of up to this many tasks have the starts of their splits in an array of some 10 MB that every task gets; larger ones join them.
LOOKED_UP_TASKS = 100_000


def _starts(marked: DataFrame) -> DataFrame:
    """One row per file split: its task, the position of its first line, and the lines of the file before it."""
    splits = marked.groupBy("arquivo", "bloco").agg(F.min("posicao").alias("_first"), F.count("*").alias("_lines"))
    before = Window.partitionBy("arquivo").orderBy("bloco").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select(
        "arquivo", "bloco", "_first", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_before"), _task(F.col("_first")).alias("_task")
    )


def _task(position):
    """The task that gave a position: positions count up from task number times 2 ** 33."""
    return F.shiftrightunsigned(position, 33).cast("int")


def number_lines(marked: DataFrame) -> DataFrame:
    """Adds ``numero_linha_origem``, the 1-based line number within the file; blank lines count.

    Only per-split counts (one small row per file split) are ordered per file. Lines are not shuffled: the starts of all splits form one
    array with an entry per task, and a line finds its split among those of its own task. For scans of more than
    ``LOOKED_UP_TASKS`` tasks the starts are joined instead.
    """
    starts = _starts(marked)
    line = F.col("posicao") - F.col("_start._first") + F.col("_start._before") + 1
    if marked.rdd.getNumPartitions() > LOOKED_UP_TASKS:
        found = marked.join(starts.select("arquivo", "bloco", F.struct("_first", "_before").alias("_start")), ["arquivo", "bloco"])
    else:
        # Every task up to the last has an entry, so that the place in the array is the number of the task.
        own = starts.groupBy("_task").agg(F.sort_array(F.collect_list(F.struct("_first", "_before"))).alias("_splits"))
        tasks = starts.agg(F.max("_task").alias("n")).select(F.explode(F.sequence(F.lit(0), "n")).alias("_task"))
        entries = F.sort_array(F.collect_list(F.struct("_task", "_splits")))
        table = tasks.join(own, "_task", "left").agg(F.transform(entries, lambda x: x["_splits"]))
        started = F.filter("_splits", lambda x: x["_first"] <= F.col("posicao"))
        found = marked.withColumn("_splits", F.get(table.scalar(), _task(F.col("posicao")))).withColumn("_start", F.element_at(started, -1))
    return found.withColumn("numero_linha_origem", line.cast("long")).drop("_splits", "_start", "posicao", "bloco")


def read_numbered_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Lines with their numbers, blank lines dropped. Both uses read the same files in the same splits, so nothing is kept."""
    return number_lines(mark_positions(scan_lines(spark.read, path, glob))).where(strip(F.col("value")) != "")


def has_files(spark: SparkSession, path: str, glob: str = "*") -> bool:
    """False when an optional source has no file yet."""
    try:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        return bool(listing.option("pathGlobFilter", glob).load(path).select("path").take(1))
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def _nested(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) or isinstance(kind, T.ArrayType) and _nested(kind.elementType)


def _unknown_fields(text, kind: T.DataType):
    """Names in a JSON text, in the objects and arrays below it too, that its type lacks."""
    none = F.array().cast("array<string>")
    if isinstance(kind, T.ArrayType):
        elements = F.from_json(text, "array<string>")
        return F.coalesce(F.flatten(F.transform(elements, lambda x: _unknown_fields(x, kind.elementType))), none)
    extra = F.array_except(F.coalesce(F.json_object_keys(text), none), F.lit([f.name for f in kind.fields]))
    for field in kind.fields:
        if _nested(field.dataType):
            extra = F.concat(extra, _unknown_fields(F.get_json_object(text, f"$.{field.name}"), field.dataType))
    return extra


def read_strict_json(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None) -> DataFrame:
    """JSON lines in which a malformed line or a field outside ``schema`` fails the read."""
    value = F.col("value")
    lines = scan_lines(spark.read, path, glob).where(strip(value) != "")
    extra = _unknown_fields(value, schema)
    refused = F.raise_error(F.concat(F.lit("unknown fields: "), F.array_join(extra, ", ")))
    parsed = F.from_json(value, schema, {"mode": "FAILFAST"})
    checked = F.when(F.size(extra) == 0, parsed).otherwise(refused.cast("void"))
    return lines.select(checked.alias("_row")).select("_row.*")


_LOG_SCHEMA = (
    "`Event` string, `Job ID` long, `Submission Time` long, `Stage IDs` array<long>, `Stage ID` long, "
    "`Job Result` struct<`Result`: string>, "
    "`Task Metrics` struct<`Input Metrics`: struct<`Bytes Read`: long>>"
)


def job_history(spark: SparkSession, path: str) -> DataFrame:
    """Finished and running jobs from Spark event logs, in the columns that ``usage`` reads.

    Task bytes are summed per stage before they meet the jobs, so the join sees one row per stage.
    """
    log = spark.read.option("recursiveFileLookup", True).schema(_LOG_SCHEMA).json(path)
    log = log.withColumn("_file", F.col("_metadata.file_path"))
    started = log.where("Event = 'SparkListenerJobStart'")
    ended = log.where("Event = 'SparkListenerJobEnd'").select(
        "_file", "Job ID", F.col("`Job Result`.`Result`").alias("_result")
    )
    read = (
        log.where("Event = 'SparkListenerTaskEnd'")
        .groupBy("_file", F.col("Stage ID").alias("_stage"))
        .agg(F.sum("`Task Metrics`.`Input Metrics`.`Bytes Read`").alias("_bytes"))
    )
    stages = started.select("_file", "Job ID", "Submission Time", F.explode("Stage IDs").alias("_stage"))
    jobs = (
        stages.join(read, ["_file", "_stage"], "left")
        .groupBy("_file", "Job ID", "Submission Time")
        .agg(F.coalesce(F.sum("_bytes"), F.lit(0)).alias("total_bytes_processed"))
    )
    failed = F.col("_result") != "JobSucceeded"
    return jobs.join(ended, ["_file", "Job ID"], "left").select(
        F.timestamp_millis("Submission Time").alias("creation_time"),
        F.lit("QUERY").alias("job_type"),
        F.when(F.col("_result").isNull(), "RUNNING").otherwise("DONE").alias("state"),
        F.lit(None).cast("string").alias("statement_type"),
        F.when(failed, F.col("_result")).alias("error_result"),
        F.lit(False).alias("cache_hit"),
        "total_bytes_processed",
        F.col("total_bytes_processed").alias("total_bytes_billed"),
    )


def count_parquet_rows(spark: SparkSession, *paths: str) -> DataFrame:
    """``(arquivo, registros)`` of Parquet files. No column is read, so the counts come from the footers."""
    return _rows_per_file(_reader(spark, "*.parquet").schema("_none int").parquet(*paths))


def count_json_rows(spark: SparkSession, *paths: str, glob: str = "*.json*") -> DataFrame:
    """``(arquivo, registros)`` of line files; blank lines do not count."""
    return _rows_per_file(_reader(spark, glob).text(list(paths)).where(strip(F.col("value")) != ""))


def count_csv_rows(spark: SparkSession, *paths: str) -> DataFrame:
    """``(arquivo, registros)`` of CSV files with a header line."""
    counted = _rows_per_file(_reader(spark, "*.csv").text(list(paths)))
    return counted.withColumn("registros", F.greatest(F.lit(0), F.col("registros") - 1))


def _count_readable_json(spark: SparkSession, *paths: str) -> DataFrame:
    """As ``count_json_rows``; null for a file with bytes that are not UTF-8."""
    text = _reader(spark, "*.json*").text(list(paths)).groupBy(F.col("_metadata.file_path").alias("arquivo"))
    whole = F.bool_and(F.is_valid_utf8("value"))
    return text.agg(F.when(whole, F.count_if(strip(F.col("value")) != "")).alias("registros"))


def count_rows_by_file(spark: SparkSession, path: str) -> DataFrame:
    """``(arquivo, registros, erro)`` over all known file types below ``path``; a broken file counts 0, all others in full.

    ``erro`` says why a file could not be counted and is null for all others, so that its 0 is told from that of an empty file. Only what
    Spark reports as a file it could not read is a broken file; any other failure (a lost executor, a file that has gone) fails the count.
    This is the tolerant count for metrics; the counts above fail on a broken file, as loads must. Broken files are found by halving
    the set of files that failed, so a few of them cost a few further passes over ever smaller sets.
    """
    kinds = {"*.parquet": count_parquet_rows, "*.json*": _count_readable_json, "*.csv": count_csv_rows}
    return reduce(DataFrame.unionByName, [_isolated(spark, path, glob, count) for glob, count in kinds.items()])


def _isolated(spark: SparkSession, path: str, glob: str, count: Callable[..., DataFrame]) -> DataFrame:
    """The counts of all files that can be read, and 0 with the reason for each of the others."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    files = [r["path"] for r in listing.load(path).select("path").collect()]
    good, broken, open_sets = [], [], [files] if files else []
    while open_sets:
        some = open_sets.pop()
        try:
            count(spark, *map(_literal, some)).agg(F.sum("registros")).first()
            good += some
        except Exception as error:
            if not _unreadable(error):
                raise
            half = len(some) // 2
            broken += [] if half else [(some[0], 0, _reason(error))]
            open_sets += [some[:half], some[half:]] if half else []
    lost = spark.createDataFrame(broken, "arquivo string, registros long, erro string")
    if not good:
        return lost
    uncounted = F.when(F.col("registros").isNull(), "not UTF-8").alias("erro")
    return count(spark, *map(_literal, good)).select("arquivo", F.coalesce("registros", F.lit(0)).alias("registros"), uncounted).unionByName(lost)


def _unreadable(error: Exception) -> bool:
    """Whether a file that is there could not be read."""
    return "[FAILED_READ_FILE." in str(error) and "[FAILED_READ_FILE.FILE_NOT_EXIST]" not in str(error)


def _reason(error: Exception) -> str:
    """The innermost cause that an error names, or its first line."""
    return [*str(error).splitlines()[:1], *re.findall(r"^Caused by: (.*)", str(error), re.MULTILINE)][-1]


def _literal(path: str) -> str:
    """A path whose special characters stand for themselves where patterns are read."""
    return re.sub(r"([*?{}\[\]\\,])", r"\\\1", path)


def _reader(spark: SparkSession, glob: str):
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)


def _rows_per_file(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("_metadata.file_path").alias("arquivo")).agg(F.count("*").alias("registros"))
