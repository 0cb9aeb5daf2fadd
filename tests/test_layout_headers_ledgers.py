"""Z-order layout, drifting headers, digests, mergeable audits, keys, rejects."""

import os
import random
import tempfile
from collections import Counter

import pyarrow.parquet as pq
import pytest
from conftest import SF_ORACLE, SF_SMALL
from pyspark.sql import functions as F

from flightmart.operators import (
    cast_with_rejects,
    content_digest,
    cut_points,
    duplicate_keys,
    file_ranges,
    key_profile,
    key_sketches,
    merge_audits,
    merged_key_profile,
    reject_counts,
    reject_ledger,
    typed_rows,
    with_zorder_key,
)
from flightmart.operators.clean import cast_columns, parse_dates
from flightmart.plans import jobs
from flightmart.sinks import publish_zordered, read_snapshot
from flightmart.sources import header_drift, header_map, raw_flights, raw_planes, read_csv_by_name


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="flightmart-test-")


def held(df):
    return Counter(map(tuple, df.collect()))


# --- layout ----------------------------------------------------------------------


def test_zorder_key_interleaves_quantile_ranks(spark):
    values = [(a, chr(97 + b)) for a in range(16) for b in range(16)]
    df = spark.createDataFrame([*values, (None, None)], "a int, b string")
    cuts = cut_points(df, ["a", "b"], bits=4)
    got = {(r.a, r.b): r.z for r in with_zorder_key(df, cuts, "z", bits=4).collect()}
    for a, b in values:
        ranks = sum(a >= c for c in cuts["a"]), sum(b >= c for c in cuts["b"])
        want = int("".join(f"{x:04b}"[i] for i in range(4) for x in ranks), 2)
        assert got[a, b] == want
    assert got[None, None] == 0 and len(set(got.values())) > 200
    with pytest.raises(ValueError):
        with_zorder_key(df, {c: [] for c in "abcdefghijk"}, bits=6)


def read_share(path, column, value):
    """Row groups of the files under ``path`` whose statistics admit a value."""
    met = total = 0
    for name in os.listdir(path):
        if name.endswith(".parquet"):
            meta = pq.ParquetFile(f"{path}/{name}").metadata
            at = meta.schema.names.index(column)
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(at).statistics
                total += 1
                met += stats is None or not stats.has_min_max or stats.min <= value <= stats.max
    return met / total


def test_a_filter_on_any_clustered_column_skips_most_row_groups(spark, tmp):
    fact = spark.read.parquet(f"{SF_ORACLE}/lineitem.parquet").select(
        F.concat(F.lit("A"), (F.col("l_suppkey") % 25).cast("string")).alias("Origin"),
        F.concat(F.lit("A"), (F.col("l_partkey") % 25).cast("string")).alias("Dest"),
        F.concat(F.lit("C"), (F.col("l_suppkey") % 20).cast("string")).alias("UniqueCarrier"),
        F.col("l_orderkey").alias("k"),
    )
    publish_zordered(fact, f"{tmp}/z", jobs.CLUSTER_COLUMNS, files=96)
    back = spark.read.parquet(f"{tmp}/z")
    assert held(back.groupBy(*fact.columns).count()) == held(fact.groupBy(*fact.columns).count())
    for column, values in (("Origin", 25), ("Dest", 25), ("UniqueCarrier", 20)):
        share = [read_share(f"{tmp}/z", column, f"{'C' if column == 'UniqueCarrier' else 'A'}{v}") for v in range(values)]
        assert sum(share) / len(share) < (1 / 2 if column == "UniqueCarrier" else 1 / 3), (column, share)
    ranges = file_ranges(back, ["Dest"]).collect()
    assert sum(r.rows for r in ranges) == fact.count() and all(r.Dest_min <= r.Dest_max for r in ranges)


def test_a_hot_combination_is_split_over_files(spark, tmp):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(7).alias("a"), F.lit(1).alias("b"), "id")
    publish_zordered(df, tmp + "/z", ["a", "b"], files=10)
    back = spark.read.parquet(tmp + "/z")
    assert back.count() == 20_000
    assert max(r.rows for r in file_ranges(back, ["a"]).collect()) < 4_000
    publish_zordered(df.limit(0), tmp + "/empty", ["a", "b"])
    assert spark.read.parquet(tmp + "/empty").count() == 0


# --- digests ---------------------------------------------------------------------


def test_digest_sees_values_not_order(spark):
    base = [(1, "a", 1.5), (2, None, None), (None, "b", 0.0), (2, None, None)]
    ddl = "i int, s string, d double"
    digest = lambda values: tuple(content_digest(spark.createDataFrame(values, ddl)).first())
    first = digest(base)
    assert digest(base[::-1]) == first == tuple(content_digest(spark.createDataFrame(base, ddl).repartition(3)).first())
    for other in (base[:-1], base + [base[0]], [(1, "a", 1.25), *base[1:]], [(1, "b", 1.5), base[1], (None, "a", 0.0), base[3]],
                  [base[0], (None, "2", None), *base[2:]]):
        assert digest(other) != first
    swap = lambda v: tuple(content_digest(spark.createDataFrame(v, "a string, b string")).first())
    assert swap([(None, "x")]) != swap([("x", None)])
    nested = spark.createDataFrame([({"k": 1}, [1, None], ("x", None))], "m map<string,int>, l array<int>, t struct<a:string,b:int>")
    assert content_digest(nested).first()["rows"] == 1
    assert tuple(content_digest(nested.limit(0)).first()) == (0, 0, 0)


# --- headers ---------------------------------------------------------------------


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)


def test_files_of_any_header_are_bound_by_name(spark, tmp):
    write(f"{tmp}/2000 a.csv", "Year,TaxiIn,Tail\n2000,5,N1\n2000,,\n")
    write(f"{tmp}/2001.csv", "﻿Tail,Year,TaxiIn\r\nN2,2001,7\r\n")
    write(f"{tmp}/2002.csv", 'TAXIIN,"Year",,Extra\n8,2002,x,y\n')
    write(f"{tmp}/2003.csv", "Year,TaxiIn,Tail\n")
    write(f"{tmp}/2004.csv", "")
    wanted = ["Year", "TaxiIn", "Tail"]
    headers = {f.rsplit("/", 1)[1]: own for f, own in header_map(spark, f"{tmp}/*.csv").items()}
    assert [headers[k] for k in sorted(headers)] == [["Year", "TaxiIn", "Tail"], ["Tail", "Year", "TaxiIn"], ["TAXIIN", "Year", "_c2", "Extra"], ["Year", "TaxiIn", "Tail"]]
    got = read_csv_by_name(spark, f"{tmp}/*.csv", wanted, file_column="file")
    assert sorted(map(str, got.drop("file").collect())) == sorted(
        map(str, spark.createDataFrame([("2000", "5", "N1"), ("2000", None, None), ("2001", "7", "N2"), ("2002", "8", None)], "Year string, TaxiIn string, Tail string").collect())
    )
    assert {r.file.rsplit("/", 1)[1][:4] for r in got.collect()} == {"2000", "2001", "2002"}
    drift = {(r.file.rsplit("/", 1)[1], r.column, r.drift, r.wanted_at, r.found_at) for r in header_drift(spark, f"{tmp}/*.csv", wanted).collect()}
    assert drift == {
        ("2001.csv", "Year", "moved", 0, 1), ("2001.csv", "TaxiIn", "moved", 1, 2), ("2001.csv", "Tail", "moved", 2, 0),
        ("2002.csv", "Year", "moved", 0, 1), ("2002.csv", "TaxiIn", "moved", 1, 0), ("2002.csv", "Tail", "absent", 2, None),
        ("2002.csv", "_c2", "extra", None, 2), ("2002.csv", "Extra", "extra", None, 3),
    }
    typed = read_csv_by_name(spark, f"{tmp}/*.csv", wanted, schema=spark.createDataFrame([], "Year int, TaxiIn double, Tail string").schema)
    assert [t for _, t in typed.dtypes] == ["int", "double", "string"] and typed.agg(F.sum("Year")).first()[0] == 8003
    for strict in ({"on_absent": "fail"}, {"on_extra": "fail"}):
        with pytest.raises(ValueError, match="2002.csv"):
            read_csv_by_name(spark, f"{tmp}/*.csv", wanted, **strict)
    with pytest.raises(ValueError):
        read_csv_by_name(spark, f"{tmp}/*.csv", wanted, on_absent="ignore")


def test_headers_that_cannot_be_bound(spark, tmp):
    write(f"{tmp}/a/x.csv", "Year,YEAR\n1,2\n")
    with pytest.raises(ValueError, match="differ only in case"):
        read_csv_by_name(spark, f"{tmp}/a", ["Year"])
    write(f"{tmp}/b/x.csv", "")
    none = read_csv_by_name(spark, f"{tmp}/b", ["Year", "Tail"], file_column="file")
    assert none.columns == ["Year", "Tail", "file"] and none.count() == 0


def test_header_job_leaves_the_session_as_it_was(spark, tmp):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(n) for n in names]
    for k in range(30):
        write(f"{tmp}/{k}.csv", f"Year,c{k}\n" + "1,2\n" * 2000)
    assert len(header_map(spark, tmp)) == 30 and [spark.conf.get(n) for n in names] == before


def test_land_by_name(spark, tmp):
    write(f"{tmp}/2000_data.csv", "Year,TaxiIn\n2000,5\n")
    write(f"{tmp}/2001_data.csv", "TaxiIn,Year\n6,2001\n")
    staged, n = jobs.land(spark, [f"{tmp}/2000_data.csv", f"{tmp}/2001_data.csv"], f"{tmp}/stage", by_name=True, verify="content")
    assert n == 2 and held(staged) == Counter([("2000", "5"), ("2001", "6")])


# --- audits, keys, rejects ---------------------------------------------------------


def test_audits_of_files_add_up_and_are_replaced(spark, tmp):
    raw = raw_flights(spark, SF_SMALL).withColumn("file", F.concat(F.lit("f/"), F.col("Month")))
    trail = jobs.flights_audit_trail(raw.drop("file"))
    damaged = raw.withColumn("DepTime", F.lit(None).cast("string")).where("file IN ('f/3', 'f/5')")
    assert jobs.refresh_audits(spark, damaged, f"{tmp}/state", "file") == 1
    assert jobs.refresh_audits(spark, raw, f"{tmp}/state", "file") == 2
    state = read_snapshot(spark, f"{tmp}/state")
    assert held(merge_audits(state)) == held(trail)
    one = held(state.where("file = 'f/3'").drop("file").select("stage", "column", "missing"))
    assert one == held(jobs.flights_audit_trail(raw.where("file = 'f/3'").drop("file")))


def test_duplicate_keys_equal_brute_force(spark):
    r = random.Random(3)
    values = [(r.choice([None, *"abcdefgh"]), r.randint(1, 40), "x") for _ in range(300)] + [("hot", 1, "x")] * 500
    df = spark.createDataFrame(values, "a string, `b.c` int, rows string")
    want = Counter((a, b) for a, b, _ in values if a is not None)
    assert held(duplicate_keys(df.drop("rows"), ["a", "b.c"])) == Counter((a, b, n) for (a, b), n in want.items() if n > 1)
    assert held(duplicate_keys(df.drop("rows"), ["a", "b.c"], least=4)) == Counter((a, b, n) for (a, b), n in want.items() if n >= 4)
    single = Counter(a for a, _, _ in values if a is not None)
    assert held(duplicate_keys(df, "a")) == Counter((a, n) for a, n in single.items() if n > 1)
    assert duplicate_keys(df.limit(0), "a").count() == 0


def test_merged_sketches_profile_a_key(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 10 > 0, F.col("id") % 3500).alias("k"), (F.col("id") % 4).alias("file"))
    sketches = key_sketches(df, "k", ["file"])
    assert sketches.count() == 4
    assert merged_key_profile(sketches).first().asDict() == key_profile(df, "k").first().asDict()
    large = spark.range(200_000).select(F.col("id").alias("k"), (F.col("id") % 4).alias("file"))
    assert abs(merged_key_profile(key_sketches(large, "k", ["file"])).first()["distinct"] / 200_000 - 1) < 0.05
    assert merged_key_profile(key_sketches(df.limit(0), "k", ["file"])).first().asDict() == {"rows": 0, "non_null": 0, "distinct": 0, "duplicates": 0}


def test_rejects_are_what_casts_lost(spark, tmp):
    values = [("k1", "12", "01/31/2000"), ("k2", "x", "02/30/2000"), ("k3", "99999999999", "2000-01-01"), ("k4", " ", "None"),
              ("k5", None, "NA"), ("k6", "NA", None), ("k7", "95.5", "12/01/1999"), ("k7", " 7 ", " ")]
    df = spark.createDataFrame(values, "key string, n string, d string")
    cast_with_rejects(df, ["n"], {"d": "MM/dd/yyyy"}).write.parquet(f"{tmp}/cast")
    both = spark.read.parquet(f"{tmp}/cast")
    assert held(typed_rows(both)) == held(parse_dates(cast_columns(df, ["n"]), {"d": "MM/dd/yyyy"}))
    assert held(reject_ledger(both, ["key"])) == Counter([
        ("k2", "n", "x", 2), ("k3", "n", "99999999999", 4), ("k4", "n", " ", 3), ("k2", "d", "02/30/2000", 8), ("k3", "d", "2000-01-01", 2),
        ("k4", "d", "None", 2), ("k7", "d", " ", 3),
    ])
    assert held(reject_counts(both))[("d", 2, 2)] == 1


def test_ledger_accounts_for_every_present_value(spark):
    raw = raw_planes(spark, SF_SMALL)
    both = cast_with_rejects(raw, jobs.PLANE_INT_COLUMNS, jobs.PLANE_DATE_PATTERNS)
    for c in ("year", "issue_date"):
        present = raw.where(f"{c} IS NOT NULL AND {c} NOT IN ('null', 'NULL', 'NA', 'NaN')").count()
        lost = sum(r.rejects for r in reject_counts(both).where(F.col("column") == c).collect())
        assert lost > 0 and typed_rows(both).where(F.col(c).isNotNull()).count() + lost == present
    assert reject_ledger(cast_with_rejects(raw.limit(0), ["year"]), ["tailnum"]).count() == 0
    assert reject_ledger(cast_with_rejects(raw), ["tailnum"]).count() == 0
