import datetime
import os
import tempfile

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from flightmart.plans import plan_text
from flightmart.session import shared_dir
from flightmart.sinks import files, publish, stage_and_verify, write_stage
from flightmart.sources import (
    read_csv_inferred,
    read_csv_strings,
    read_stage,
    resolve_sources,
    year_paths,
)
from flightmart.streaming import land_incrementally


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="flightmart-test-")


def test_year_paths():
    assert year_paths("gs://b/", 2000, 2002) == [
        "gs://b/2000_data.csv",
        "gs://b/2001_data.csv",
        "gs://b/2002_data.csv",
    ]


def test_read_csv_strings_many_files(spark, tmp):
    _write(f"{tmp}/2000_data.csv", "Year,TaxiIn\n2000,5\n2000,NA\n")
    _write(f"{tmp}/2001_data.csv", "Year,TaxiIn\n2001,\n")
    df = read_csv_strings(spark, year_paths(tmp, 2000, 2001))
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "string"]
    assert sorted(tuple(r) for r in df.collect()) == [("2000", "5"), ("2000", "NA"), ("2001", None)]


def test_strict_header_rejects_reordered_file(spark, tmp):
    _write(f"{tmp}/2000_data.csv", "Year,TaxiIn\n2000,5\n")
    _write(f"{tmp}/2001_data.csv", "TaxiIn,Year\n6,2001\n")
    with pytest.raises(Exception):
        read_csv_strings(spark, year_paths(tmp, 2000, 2001)).collect()
    lenient = read_csv_strings(spark, year_paths(tmp, 2000, 2001), strict_header=False)
    assert sorted(tuple(r) for r in lenient.collect()) == [("2000", "5"), ("6", "2001")]


def test_blank_header_cells_get_positional_names(spark, tmp):
    _write(f"{tmp}/vars.csv", "Variable descriptions,,\n1,Year,1987-2008\n,,\n2,Month,1-12\n")
    df = read_csv_inferred(spark, f"{tmp}/vars.csv")
    assert df.columns == ["Variable descriptions", "_c1", "_c2"]
    assert df.schema["Variable descriptions"].dataType.simpleString() == "int"


def test_bz2_roundtrip(spark, tmp):
    src = spark.createDataFrame([("2000", "NA"), ("2000", "7")], "Year string, TaxiIn string")
    src.write.option("header", True).option("compression", "bzip2").csv(f"{tmp}/bz")
    assert any(n.endswith(".csv.bz2") for n in os.listdir(f"{tmp}/bz"))
    back = read_csv_strings(spark, [f"{tmp}/bz"])
    assert sorted(tuple(r) for r in back.collect()) == [("2000", "7"), ("2000", "NA")]


def test_bz2_files_are_even_whatever_the_row_groups(spark, tmp):
    import __spark_entry__ as entry

    rows = spark.range(0, 30_000, 1, 1).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 500).alias("l_partkey"), (F.col("id") % 70).alias("l_suppkey"),
        (F.col("id") % 4).cast("int").alias("l_linenumber"), F.lit(datetime.date(1995, 3, 1)).alias("l_shipdate"),
    )
    for name, some in (("rows", rows), ("none", rows.where("l_orderkey < 0"))):
        some.write.parquet(f"{tmp}/{name}/lineitem.parquet")
        back, raw = entry.q_bz2_roundtrip(spark, f"{tmp}/{name}"), entry.raw_flights(spark, f"{tmp}/{name}")
        assert back.columns == raw.columns
        assert back.exceptAll(raw).count() == raw.exceptAll(back).count() == 0
        sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
        n = 3 * spark.sparkContext.defaultParallelism if name == "rows" else 0
        assert len(sizes) == n and all(abs(x - 30_000 / n) <= 2 for x in sizes)


def test_resolve_sources_policies(spark, tmp):
    _write(f"{tmp}/2001_data.csv", "a\n1\n")
    paths = year_paths(tmp, 2000, 2001)
    with pytest.raises(FileNotFoundError):
        resolve_sources(spark, paths, "fail")
    assert resolve_sources(spark, paths, "skip") == [paths[1]]
    with pytest.raises(FileNotFoundError):
        resolve_sources(spark, paths[:1], "skip")


def test_even_partitions_grow_with_the_input(spark, tmp, monkeypatch):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("s"), F.lit("same").alias("t"))
    write_stage(df, f"{tmp}/in")
    back = spark.read.parquet(f"{tmp}/in")
    assert files.even_partitions(back, 3).rdd.getNumPartitions() == 3
    monkeypatch.setattr(files, "EVEN_BYTES", files.estimated_bytes(back) // 10)
    staged, n = stage_and_verify(back, f"{tmp}/even", 3)
    sizes = [r["count"] for r in staged.groupBy(F.input_file_name()).count().collect()]
    assert n == 20_000 and 10 <= len(sizes) <= 12 and max(sizes) < 2_200
    assert staged.exceptAll(back).count() == 0


def test_wide_stages_are_compiled_whatever_the_session(spark):
    from flightmart.plans.jobs import clean_flights
    from flightmart.session import settings
    from flightmart.sources import raw_flights

    limit = "spark.sql.codegen.hugeMethodLimit"
    for held, after in (("65535", "8000"), ("4000", "4000")):
        with settings(spark, {limit: held, "spark.sql.maxConcurrentOutputFileWriters": "7"}):
            clean_flights(raw_flights(spark, SF_SMALL))
            assert spark.conf.get(limit) == after
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_stage_and_verify(spark, tmp):
    df = spark.range(1000).withColumn("s", F.col("id").cast("string"))
    staged, n = stage_and_verify(df, f"{tmp}/stage", 4)
    assert n == 1000
    assert len([f for f in os.listdir(f"{tmp}/stage") if f.endswith(".parquet")]) == 4
    assert staged.count() == 1000
    write_stage(df, f"{tmp}/stage")  # overwrite is allowed
    assert read_stage(spark, f"{tmp}/stage").count() == 1000


def test_publish_partitioned_and_pruned(spark, tmp):
    df = spark.createDataFrame(
        [(datetime.date(2008, 1, d % 3 + 1), f"A{d % 5}", f"B{d % 2}", "C", d) for d in range(60)],
        "FlightDate date, Origin string, Dest string, UniqueCarrier string, n int",
    )
    publish(df, f"{tmp}/fact", partition_by=["FlightDate"], cluster_by=["Origin", "Dest", "UniqueCarrier"])
    dirs = sorted(d for d in os.listdir(f"{tmp}/fact") if d.startswith("FlightDate="))
    assert dirs == ["FlightDate=2008-01-01", "FlightDate=2008-01-02", "FlightDate=2008-01-03"]
    back = spark.read.parquet(f"{tmp}/fact")
    assert back.schema["FlightDate"].dataType.simpleString() == "date"
    one_day = back.filter(F.col("FlightDate") == datetime.date(2008, 1, 2))
    assert one_day.count() == 20
    assert "PartitionFilters: [isnotnull(FlightDate" in plan_text(one_day)
    # rows inside each file are ordered by the clustering columns
    for d in dirs:
        files = [f for f in os.listdir(f"{tmp}/fact/{d}") if f.endswith(".parquet")]
        for f in files:
            rows = spark.read.parquet(f"{tmp}/fact/{d}/{f}").collect()
            keys = [(r.Origin, r.Dest, r.UniqueCarrier) for r in rows]
            assert keys == sorted(keys)


def test_publish_unpartitioned_lookup(spark, tmp):
    df = spark.range(100).repartition(10)
    publish(df, f"{tmp}/lookup")
    files = [f for f in os.listdir(f"{tmp}/lookup") if f.endswith(".parquet")]
    assert len(files) < 10  # small table is coalesced by adaptive execution
    assert spark.read.parquet(f"{tmp}/lookup").count() == 100


def test_shared_dir_reads_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b
    assert a.startswith(base.rstrip("/"))


def test_streaming_landing_is_incremental(spark, tmp):
    cols = ["Year", "TaxiIn", "CarrierDelay"]
    _write(f"{tmp}/in/2000/part-0.csv", "Year,TaxiIn,CarrierDelay\n2000,5,NA\n2000,NA,NA\n")
    stage = f"{tmp}/stage"
    land_incrementally(spark, f"{tmp}/in/*/", cols, stage)
    first = read_stage(spark, stage)
    assert first.columns == ["Year", "TaxiIn"]  # delay column dropped
    assert first.count() == 2
    _write(f"{tmp}/in/2001/part-0.csv", "Year,TaxiIn,CarrierDelay\n2001,7,NA\n")
    land_incrementally(spark, f"{tmp}/in/*/", cols, stage)
    second = read_stage(spark, stage)
    assert sorted(tuple(r) for r in second.collect()) == [("2000", "5"), ("2000", "NA"), ("2001", "7")]


def test_publish_splits_a_hot_partition_value(spark, tmp):
    """One date holding a third of all rows is written by several tasks."""
    hot = datetime.date(2008, 1, 1)
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot))
        .otherwise(F.date_add(F.lit(hot), (F.col("id") % 50 + 1).cast("int")))
        .alias("FlightDate"),
        F.concat(F.lit("A"), (F.col("id") % 97).cast("string")).alias("Origin"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        publish(df, f"{tmp}/skew", partition_by=["FlightDate"], cluster_by=["Origin"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot_files = [f for f in os.listdir(f"{tmp}/skew/FlightDate=2008-01-01") if f.endswith(".parquet")]
    assert len(hot_files) > 1
    back = spark.read.parquet(f"{tmp}/skew")
    assert back.count() == 30000
    assert back.filter(F.col("FlightDate") == hot).count() == 10000


def test_session_defaults_are_applied(spark):
    from flightmart.session import DEFAULT_CONF, get_session

    s = get_session()  # reuses the running session and sets the SQL defaults on it
    assert s.conf.get("spark.sql.codegen.hugeMethodLimit") == DEFAULT_CONF["spark.sql.codegen.hugeMethodLimit"]
    assert s.conf.get("spark.sql.adaptive.enabled") == "true"


def test_publish_without_rebalance_writes_from_scan_tasks(spark, tmp):
    """Date-ordered input: no shuffle, files per date bounded by the tasks spanning it."""
    df = spark.createDataFrame(
        [(datetime.date(2008, 1, 1 + i // 10), f"A{i % 3}", i) for i in range(40)], "FlightDate date, Origin string, n int"
    ).coalesce(2)
    publish(df, f"{tmp}/noreb", partition_by=["FlightDate"], cluster_by=["Origin"], rebalance=False)
    back = spark.read.parquet(f"{tmp}/noreb")
    assert sorted(r.n for r in back.collect()) == list(range(40))
    for d in sorted(x for x in os.listdir(f"{tmp}/noreb") if x.startswith("FlightDate=")):
        assert len([f for f in os.listdir(f"{tmp}/noreb/{d}") if f.endswith(".parquet")]) <= 2


def test_lookup_job_with_explicit_schema(spark, tmp):
    from flightmart.plans import jobs

    _write(f"{tmp}/planes.csv", "tailnum,type,issue_date,model,year\nN1,Jet,02/03/1999,A,1999\nN2,,None,B,None\n")
    schema = "tailnum string, type string, issue_date string, model string, year string"
    jobs.lookup_job(spark, f"{tmp}/planes.csv", jobs.clean_planes, f"{tmp}/planes_out", schema=schema)
    rows = spark.read.parquet(f"{tmp}/planes_out").collect()
    assert [(r.tailnum, str(r.issue_date), r.year) for r in rows] == [("N1", "1999-02-03", 1999)]


def test_publish_is_whole_under_dynamic_overwrite(spark, tmp):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for day in ("2000-01-02", "2000-01-03"):
            publish(spark.sql(f"SELECT 1 AS n, date '{day}' AS d"), f"{tmp}/t", partition_by=["d"])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert [str(r.d) for r in spark.read.parquet(f"{tmp}/t").collect()] == ["2000-01-03"]


def test_stream_rejects_other_header_order(spark, tmp):
    _write(f"{tmp}/in/2000/part-0.csv", "TaxiIn,Year\n5,2000\n")
    with pytest.raises(Exception, match="(?i)header|schema|stream"):
        land_incrementally(spark, f"{tmp}/in/*/", ["Year", "TaxiIn"], f"{tmp}/stage")


def test_publish_as_table_replaces_whole(spark, tmp):
    name = f"mart_{os.path.basename(tmp).replace('-', '_').lower()}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp}/{name}'")
    df = spark.createDataFrame([("2001-01-01", 1), ("2001-01-02", 2)], "d string, x int")
    publish(df, f"{name}.t", partition_by=["d"], as_table=True)
    publish(df.where("x = 2"), f"{name}.t", partition_by=["d"], as_table=True)
    assert [(r.x, str(r.d)) for r in spark.table(f"{name}.t").collect()] == [(2, "2001-01-02")]
    publish(df, f"{name}.u", as_table=True)
    assert spark.table(f"{name}.u").count() == 2
    spark.sql(f"DROP DATABASE {name} CASCADE")
