import os

import pytest
from litmark import session
from litmark.session import release_scratch, scratch_folder


@pytest.fixture
def root(tmp_path, monkeypatch):
    """A folder of scratch tables of its own, as those of the tests' application are still in use."""
    own = tmp_path / "litmark-own"
    monkeypatch.setattr(session, "_scratch_root", lambda spark: str(own))
    return own


def test_scratch_lies_below_the_shared_folder_by_application(spark):
    one, two = (scratch_folder(spark, "t") for _ in range(2))
    assert one != two
    assert one.startswith(f"{spark.conf.get('spark.checkpoint.dir')}/litmark-{spark.sparkContext.applicationId}/t-")


def test_release_removes_only_what_the_application_wrote(spark, root):
    other, beside = root.parent / "litmark-other", root.parent / "checkpoints"
    for folder in (other, beside):
        folder.mkdir()
        (folder / "part").write_text("x")
    paths = [scratch_folder(spark, "t") for _ in range(2)]
    for path in paths:
        spark.range(10).write.parquet(path)
    assert release_scratch(spark) > 0
    assert not any(os.path.exists(p) for p in paths)
    assert (other / "part").read_text() == (beside / "part").read_text() == "x"


def test_release_without_scratch_and_use_afterwards(spark, root):
    assert release_scratch(spark) == 0
    path = scratch_folder(spark, "t")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    assert release_scratch(spark) > 0 and release_scratch(spark) == 0
