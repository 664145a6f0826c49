"""Publishing and committing: what readers see when writers die or meet."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from rentscope.schemas import RAW_LISTINGS
from rentscope.sources import commits, files

STAMPS = ("20260101_000000", "20260102_000000")


def listings(spark, *ids):
    return spark.createDataFrame([(i, "a", 1, "$1", "x", "l", None, "feed") for i in ids], RAW_LISTINGS)


def seen(spark, target):
    rows = files.read_published(spark, target, RAW_LISTINGS).select("snapshot_ts", "listing_seq").collect()
    return sorted(map(tuple, rows))


@pytest.fixture()
def root(spark):
    root = tempfile.mkdtemp(prefix="rs-commit-")
    files.write_snapshot(listings(spark, 1, 2), f"{root}/in", STAMPS[0])
    return root


def publish(spark, root):
    return files.publish_snapshots(spark, f"{root}/in", f"{root}/zone", RAW_LISTINGS)


def test_only_new_stamps_are_written(spark, root):
    publish(spark, root)
    first = files.child_names(spark, f"{root}/zone/snapshot_ts={STAMPS[0]}")
    files.write_snapshot(listings(spark, 3), f"{root}/in", STAMPS[1])
    publish(spark, root)
    publish(spark, root)
    assert files.child_names(spark, f"{root}/zone/snapshot_ts={STAMPS[0]}") == first
    assert commits.read_state(spark, f"{root}/zone")[0] == 2  # nothing new: no commit
    assert files.published(spark, f"{root}/zone") == {STAMPS[0]: 2, STAMPS[1]: 1}
    assert seen(spark, f"{root}/zone") == [(STAMPS[0], 1), (STAMPS[0], 2), (STAMPS[1], 3)]


def test_a_snapshot_that_grew_is_published_again(spark, root):
    publish(spark, root)
    files.write_snapshot(listings(spark, 9), f"{root}/in", STAMPS[0])
    publish(spark, root)
    assert seen(spark, f"{root}/zone") == [(STAMPS[0], 1), (STAMPS[0], 2), (STAMPS[0], 9)]
    assert len(files.vacuum(spark, f"{root}/zone")) == 1 and len(seen(spark, f"{root}/zone")) == 3


def test_a_killed_publish_is_done_again(spark, root, monkeypatch):
    def killed(*_):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(files, "commit", killed)
        with pytest.raises(RuntimeError):
            publish(spark, root)
    assert seen(spark, f"{root}/zone") == [] and files.published(spark, f"{root}/zone") == {}
    publish(spark, root)
    assert len(seen(spark, f"{root}/zone")) == 2
    assert len(files.vacuum(spark, f"{root}/zone")) == 1
    assert len(seen(spark, f"{root}/zone")) == 2 and files.vacuum(spark, f"{root}/zone") == []


@pytest.mark.parametrize("left", [f"snapshot_ts={STAMPS[0]}/_temporary/0", f"snapshot_ts={STAMPS[0]}/run-dead/_temporary/0",
                                  "listings_20260101_000000/_temporary/0"])
def test_a_half_written_target_is_no_snapshot(spark, root, left):
    os.makedirs(f"{root}/zone/{left}")
    publish(spark, root)
    assert len(seen(spark, f"{root}/zone")) == 2
    files.write_named_snapshot(listings(spark, 4), f"{root}/named", stamp=STAMPS[0], fmt="parquet")
    files.publish_named_snapshots(spark, f"{root}/named", f"{root}/zone", RAW_LISTINGS, fmt="parquet")
    assert (f"listings_{STAMPS[0]}", 4) in seen(spark, f"{root}/zone")


def test_an_incomplete_commit_does_not_count(spark, root):
    publish(spark, root)
    with open(f"{root}/zone/_commits/{2:012d}.json", "w") as fh:
        fh.write('{"snapshots": {')
    assert len(seen(spark, f"{root}/zone")) == 2
    files.write_snapshot(listings(spark, 3), f"{root}/in", STAMPS[1])
    publish(spark, root)
    assert len(seen(spark, f"{root}/zone")) == 3 and commits.read_state(spark, f"{root}/zone")[0] == 3


def test_the_second_of_two_writers_fails(spark, root):
    target = f"{root}/state"
    assert commits.read_state(spark, target) == (0, {})
    commits.commit(spark, target, 0, {"by": "first"})
    with pytest.raises(commits.CommitConflict):
        commits.commit(spark, target, 0, {"by": "second"})
    assert commits.read_state(spark, target) == (1, {"by": "first"})
    assert commits.commit(spark, target, 1, {"by": "second"}) == 2


def test_published_zone_reads_as_partitions(spark, root):
    """Readers that know nothing of commits see stamps as a partition column."""
    publish(spark, root)
    got = spark.read.parquet(f"{root}/zone").select(F.col("snapshot_ts").cast("string"), "listing_seq").collect()
    assert sorted(map(tuple, got)) == seen(spark, f"{root}/zone")
