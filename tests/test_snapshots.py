"""Versions of published tables: atomic, incremental, verified."""

import os
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from flightmart.sinks import (
    ConflictError,
    expire_snapshots,
    publish_increment,
    publish_snapshot,
    read_snapshot,
    snapshot_record,
    snapshot_versions,
    snapshots,
)
from flightmart.sinks import files as sink_files
from flightmart.sinks import stage_and_verify
from flightmart.streaming import publish_incrementally

SCHEMA = "day string, n int, name string"


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="flightmart-test-") + "/table"


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def held(df):
    return Counter(map(tuple, df.collect()))


A, B, C = ("d1", 1, "a"), ("d2", 2, "b"), (None, 3, None)


def test_versions_and_time_travel(spark, root):
    assert snapshot_versions(spark, root) == []
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, root)
    assert publish_snapshot(rows(spark, A, A, B), root) == 1
    first = read_snapshot(spark, root)
    assert publish_snapshot(rows(spark, C), root, verify=True) == 2
    assert held(first) == Counter({A: 2, B: 1}) == held(read_snapshot(spark, root, 1))
    assert held(read_snapshot(spark, root)) == Counter([C]) and snapshot_versions(spark, root) == [1, 2]
    assert publish_snapshot(spark.createDataFrame([(1.5,)], "other double"), root) == 3
    assert read_snapshot(spark, root).dtypes == [("other", "double")]
    with pytest.raises(ValueError):
        read_snapshot(spark, root, 9)


@pytest.mark.parametrize("partition_by", [(), ("day",), ("day", "n")])
def test_partitions_and_odd_values(spark, root, partition_by):
    odd = [A, B, C, ("a/b=c %", 4, "é"), ("", 5, "")]
    publish_snapshot(rows(spark, *odd), root, partition_by, ["name"])
    got = read_snapshot(spark, root)
    assert got.columns == ["day", "n", "name"] and [t for _, t in got.dtypes] == ["string", "int", "string"]
    if "day" in partition_by:  # a partition folder cannot tell empty text from NULL
        odd[-1] = (None, 5, "")
    assert held(got) == Counter(odd)


def test_empty_table(spark, root):
    publish_snapshot(rows(spark, A).limit(0), root, ["day"])
    assert read_snapshot(spark, root).count() == 0 and read_snapshot(spark, root).columns == ["day", "n", "name"]
    publish_increment(rows(spark, A).limit(0), root, ["day"])
    publish_increment(rows(spark, B), root, ["day"])
    assert held(read_snapshot(spark, root)) == Counter([B])


def test_a_job_that_dies_while_writing_leaves_the_version_before(spark, root):
    publish_snapshot(rows(spark, A, B), root, ["day"])
    bad = spark.range(0, 1000, 1, 8).select(
        F.lit("d1").alias("day"),
        F.when(F.col("id") == 999, F.raise_error(F.lit("gone"))).otherwise(F.col("id")).cast("int").alias("n"),
        F.lit("x").alias("name"),
    )
    for write in (lambda: publish_snapshot(bad, root, ["day"]), lambda: publish_increment(bad, root, ["day"])):
        with pytest.raises(Exception, match="gone"):
            write()
        assert held(read_snapshot(spark, root)) == Counter([A, B]) and snapshot_versions(spark, root) == [1]


def test_a_job_that_dies_before_its_record_leaves_the_version_before(spark, root, monkeypatch):
    publish_snapshot(rows(spark, A), root, ["day"])

    def die(*_):
        raise SystemExit

    with monkeypatch.context() as m:
        m.setattr(snapshots, "_commit", die)
        with pytest.raises(SystemExit):
            publish_increment(rows(spark, ("d1", 9, "z")), root, ["day"], stream="s", batch=0)
    assert held(read_snapshot(spark, root)) == Counter([A])
    assert publish_increment(rows(spark, ("d1", 9, "z")), root, ["day"], stream="s", batch=0) == 2
    assert held(read_snapshot(spark, root)) == Counter([A, ("d1", 9, "z")])


def test_the_later_of_two_writers_is_told(spark, root, monkeypatch):
    publish_snapshot(rows(spark, A), root)
    write = snapshots._write

    def slow(df, *rest):
        done = write(df, *rest)
        monkeypatch.setattr(snapshots, "_write", write)
        publish_snapshot(rows(spark, B), root)
        return done

    monkeypatch.setattr(snapshots, "_write", slow)
    with pytest.raises(ConflictError):
        publish_snapshot(rows(spark, C), root)
    assert held(read_snapshot(spark, root)) == Counter([B]) and snapshot_versions(spark, root) == [1, 2]
    assert sorted(n for n in os.listdir(f"{root}/_versions") if n[0] != ".") == ["000000000001.json", "000000000002.json"]


def test_increments_rebuild_only_the_partitions_they_touch(spark, root):
    publish_increment(rows(spark, A, B), root, ["day"], ["n"])
    (before,) = snapshot_record(spark, root)["live"]
    publish_increment(rows(spark, ("d2", 7, "new"), ("d3", 8, "new")), root, ["day"], ["n"], verify=True)
    live = snapshot_record(spark, root)["live"]
    assert live[before] == ["day=d1"] and sorted(p for own in live.values() for p in own) == ["day=d1", "day=d2", "day=d3"]
    assert held(read_snapshot(spark, root)) == Counter([A, B, ("d2", 7, "new"), ("d3", 8, "new")])
    publish_increment(rows(spark, ("d2", 0, "only")), root, ["day"], replace=True)
    assert held(read_snapshot(spark, root)) == Counter([A, ("d2", 0, "only"), ("d3", 8, "new")])
    with pytest.raises(ValueError):
        publish_increment(rows(spark, A).drop("name"), root, ["day"])
    with pytest.raises(ValueError):
        publish_increment(rows(spark, A), root, [])


def test_a_batch_given_again_changes_nothing(spark, root):
    assert publish_increment(rows(spark, A), root, ["day"], stream="s", batch=0) == 1
    assert publish_increment(rows(spark, A), root, ["day"], stream="s", batch=0) is None
    assert publish_increment(rows(spark, A), root, ["day"], stream="t", batch=0) == 2
    assert publish_increment(rows(spark, B), root, ["day"], stream="s", batch=1) == 3
    assert publish_increment(rows(spark, B), root, ["day"], stream="s", batch=0) is None
    assert held(read_snapshot(spark, root)) == Counter({A: 2, B: 1})
    publish_snapshot(rows(spark, A), root, ["day"])
    assert publish_increment(rows(spark, B), root, ["day"], stream="s", batch=1) is None


def test_expired_versions_go_and_live_folders_stay(spark, root):
    publish_increment(rows(spark, A, B), root, ["day"])
    publish_increment(rows(spark, ("d3", 3, "c")), root, ["day"])
    publish_snapshot(rows(spark, C), root, ["day"])
    publish_increment(rows(spark, A), root, ["day"])
    assert expire_snapshots(spark, root, 9) == []
    gone = expire_snapshots(spark, root, 2)
    assert len(gone) == 2 and snapshot_versions(spark, root) == [3, 4]
    assert held(read_snapshot(spark, root)) == Counter([A, C]) and held(read_snapshot(spark, root, 3)) == Counter([C])
    with pytest.raises(ValueError):
        expire_snapshots(spark, root, 0)


def test_verification_finds_a_changed_cell(spark, root, monkeypatch):
    df = spark.range(100).select(F.lit("d1").alias("day"), F.col("id").cast("int").alias("n"), F.lit(None).cast("string").alias("name"))
    real = sink_files.digest_of
    assert stage_and_verify(df, f"{root}-a", verify="content")[1] == 100
    changed = F.when(F.col("n") == 5, 6).otherwise(F.col("n"))
    for module in (sink_files, snapshots):
        monkeypatch.setattr(module, "digest_of", lambda d: real(d.withColumn("n", changed)))
    with pytest.raises(RuntimeError, match="not those that were written"):
        stage_and_verify(df, f"{root}-b", verify="content")
    assert stage_and_verify(df, f"{root}-c")[1] == 100  # a count alone does not see it
    with pytest.raises(RuntimeError, match="read back"):
        publish_snapshot(df, root, verify=True)
    assert snapshot_versions(spark, root) == []
    with pytest.raises(ValueError):
        stage_and_verify(df, f"{root}-d", verify="all")


def test_two_landings_and_a_replay_equal_one_run(spark, root):
    same = lambda df: df
    columns, source = ["day", "n", "name"], f"{root}-files"
    landings = [[A, B, ("d1", 5, "x")], [("d1", 6, "y"), ("d4", 7, "z")]]
    for k, values in enumerate(landings):
        rows(spark, *values).write.option("header", True).csv(f"{source}/{k}")
        made = publish_incrementally(spark, f"{source}/*", columns, root, transform=same, partition_by=["day"], cluster_by=["n"])
        assert made == 1
    assert publish_incrementally(spark, f"{source}/*", columns, root, transform=same, partition_by=["day"]) == 0
    # The job dies after publishing: the checkpoint has not heard of the batch and runs it again.
    for name in ("1", ".1.crc"):
        os.rename(f"{root}/_checkpoint/commits/{name}", f"{root}-{name}")
    assert publish_incrementally(spark, f"{source}/*", columns, root, transform=same, partition_by=["day"]) == 0
    want = Counter((d, str(n), t) for values in landings for d, n, t in values)
    assert held(read_snapshot(spark, root)) == want and snapshot_versions(spark, root) == [1, 2]
