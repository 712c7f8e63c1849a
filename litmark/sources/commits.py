"""The commit point of a table folder: numbered files in ``_commits`` that name the folders which belong to the table.

A writer puts its data into new folders first and then adds one small file, which lists what is valid from now on. Readers follow the
newest such file. A writer that dies before leaves folders that no file names; one that dies after has finished. One writer at a time is
expected; a second one finds the next number taken and fails without having changed anything.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from litmark.sources.publish import child_names, filesystem, remove_folder

LOG = "_commits"
#: Commit files that stay; older ones are removed.
KEPT = 10


class CommitConflictError(RuntimeError):
    """Another writer has committed meanwhile."""


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = child_names(spark, f"{path}/{LOG}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _file(path: str, number: int) -> str:
    return f"{path}/{LOG}/{number:012d}.json"


def last_commit(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the newest commit below ``path``; 0 and nothing where there is none."""
    numbers = _numbers(spark, path)
    if not numbers:
        return 0, {}
    files, target = filesystem(spark, _file(path, numbers[-1]))
    stream = files.open(target)
    try:
        return numbers[-1], json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, path: str, after: int, state: dict, retired: list[str] = (), grace: int = 0) -> int:
    """Make ``state`` valid as the commit that follows number ``after``; returns its number.

    ``retired`` names folders below ``path`` that ``state`` no longer holds. They are deleted ``grace`` commits later, so readers that
    followed an earlier commit can finish; until then they are listed in the commits.
    """
    number = after + 1
    waiting = [[number, name] for name in retired] + state.get("retired", [])
    due = [name for at, name in waiting if number - at >= grace]
    body = json.dumps({**state, "retired": [w for w in waiting if w[1] not in due]})
    target = _file(path, number)
    files, draft = filesystem(spark, f"{path}/{LOG}/_draft-{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(body, "utf-8"))
    finally:
        stream.close()
    place = filesystem(spark, target)[1]
    if files.exists(place) or not files.rename(draft, place):
        files.delete(draft, False)
        raise CommitConflictError(f"commit {number} of {path} exists already")
    # The commit is valid from here on. What follows frees space, and is made up for by the next commit if it is cut off.
    for name in due:
        remove_folder(spark, f"{path}/{name}")
    for old in _numbers(spark, path)[:-KEPT]:
        files.delete(filesystem(spark, _file(path, old))[1], False)
    return number
