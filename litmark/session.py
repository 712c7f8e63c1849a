"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from litmark.sources.publish import filesystem, folder_bytes, remove_folder
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Times are UTC. Adaptive planning splits oversized join partitions. Generated methods above 8000 bytes of bytecode are
# not compiled by the JVM; with this limit Spark uses smaller methods instead.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """The settings the engine relies on, for a session that was built elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "litmark", master: str | None = None, **settings: str) -> SparkSession:
    """Session with UTC timestamps and adaptive execution; extra settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        **RUNTIME_SETTINGS,
        "spark.sql.parquet.compression.codec": "zstd",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


SHUFFLE_SETTING = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Compressed input bytes per shuffle partition; such a partition fits in the memory of a task after decompression.
INPUT_BYTES_PER_PARTITION = 32 * 1024 * 1024


@contextmanager
def sized_shuffles(spark: SparkSession, *paths: str) -> Iterator[int]:
    """Shuffles start with as many partitions as the files below ``paths`` need; adaptive planning merges small ones.

    Sizes come from listing the files, so name the folders that are read and no others.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    size = listing.agg(F.sum("length")).first()[0] or 0
    before = spark.conf.get(SHUFFLE_SETTING, None)
    usual = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(usual, size // INPUT_BYTES_PER_PARTITION)
    spark.conf.set(SHUFFLE_SETTING, str(wanted))
    try:
        yield wanted
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_SETTING)
        else:
            spark.conf.set(SHUFFLE_SETTING, before)


# Folder of this machine by application, for local masters without a shared folder.
_LOCAL: dict[str, str] = {}


def _scratch_root(spark: SparkSession) -> str:
    """The folder that holds all scratch tables of this application, and none of others."""
    application = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        if application not in _LOCAL:
            _LOCAL[application] = tempfile.mkdtemp(prefix="litmark-")
        shared = _LOCAL[application]
    return f"{shared.rstrip('/')}/litmark-{application}"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new, unused path below the folder the cluster shares (``spark.checkpoint.dir``).

    Only a local master may fall back to a temporary folder of this machine. Paths stay until ``release_scratch``.
    """
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def release_scratch(spark: SparkSession) -> int:
    """Delete every scratch table of this application and return how many bytes they had.

    Results read them lazily, so call this once all results are written or collected. Scratch tables of other applications stay.
    """
    root = _scratch_root(spark)
    files, target = filesystem(spark, root)
    if not files.exists(target):
        return 0
    size = folder_bytes(spark, root)
    remove_folder(spark, root)
    return size
