import os
import tempfile

import pytest

from flightmart.__main__ import main


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


HEADER = (
    "Year,Month,DayofMonth,DayOfWeek,DepTime,CRSDepTime,ArrTime,CRSArrTime,UniqueCarrier,FlightNum,TailNum,"
    "ActualElapsedTime,CRSElapsedTime,AirTime,ArrDelay,DepDelay,Origin,Dest,Distance,TaxiIn,TaxiOut,Cancelled,"
    "CancellationCode,Diverted,CarrierDelay,WeatherDelay,NASDelay,SecurityDelay,LateAircraftDelay\n"
)


def test_cli_flights_and_lookup(spark, capsys):
    d = tempfile.mkdtemp(prefix="flightmart-cli-")
    _write(f"{d}/in/2007_data.csv", HEADER + "2007,1,2,3,NA,900,1100,1105,AA,12,UNKNOW,95.5,120,NA,NA,3,SFO,LAX,337,5,10,0,,0,NA,NA,NA,NA,NA\n")
    _write(f"{d}/in/2008_data.csv", HEADER + "2008,2,9,6,830,830,NaN,1010,UA,7,N1é,100,100,80,4,-2,JFK,BOS,187,NA,12,0,,0,NA,NA,NA,NA,NA\n")
    assert main(["flights", "--source", f"{d}/in", "--stage", f"{d}/stage", "--target", f"{d}/fact", "--first", "2006", "--last", "2008", "--on-missing", "skip"]) == 0
    rows = spark.read.parquet(f"{d}/fact").collect()
    assert len(rows) == 1  # the 2008 row has no taxi-in time
    r = rows[0]
    assert (r.DepTime, r.AirTime, r.ArrDelay, r.ActualElapsedTime, r.TailNum, r.MissingData) == (
        900, 80, 0, 95, "Unknown Tail Number", 1
    )
    assert str(r.FlightDate) == "2007-01-02"
    assert main(["audit", "--stage", f"{d}/stage"]) == 0
    assert "after_air_time" in capsys.readouterr().out
    _write(f"{d}/carriers.csv", "Code,Description\nNA,North American\nAA,American\n")
    assert main(["carriers", "--source", f"{d}/carriers.csv", "--target", f"{d}/carriers"]) == 0
    assert sorted(r.Code for r in spark.read.parquet(f"{d}/carriers").collect()) == ["AA", "NA"]


def test_flights_job_resumes_from_a_stage_of_the_same_sources_only(spark, monkeypatch):
    from flightmart.plans import jobs
    from flightmart.sources.files import _listable

    d = tempfile.mkdtemp(prefix="flightmart-resume-")
    _write(f"{d}/in/2007_data.csv", HEADER + "2007,1,2,3,NA,900,1100,1105,AA,12,N1,100,120,NA,NA,3,SFO,LAX,337,5,10,0,,0,NA,NA,NA,NA,NA\n")
    assert jobs.flights_job(spark, f"{d}/in", f"{d}/stage", f"{d}/fact", 2007, 2007) == 1
    landed = []
    land = jobs.land
    monkeypatch.setattr(jobs, "land", lambda *a, **k: landed.append(a[1]) or land(*a, **k))
    run = lambda last, **k: jobs.flights_job(spark, f"{d}/in", f"{d}/stage", f"{d}/fact2", 2007, last, reuse_stage=True, **k)
    assert run(2007) == 1 and not landed
    assert spark.read.parquet(f"{d}/fact2").count() == 1
    # an absent source root, other years, a changed file and a stage without a manifest are not taken for the same
    with pytest.raises(FileNotFoundError):
        jobs.flights_job(spark, f"{d}/absent", f"{d}/stage", f"{d}/fact2", 2007, 2007, reuse_stage=True)
    _write(f"{d}/in/2008_data.csv", HEADER + "2008,2,9,6,830,830,1000,1010,UA,7,N1,100,100,80,4,-2,JFK,BOS,187,4,12,0,,0,NA,NA,NA,NA,NA\n")
    assert run(2008) == 2 and len(landed) == 1
    assert run(2008) == 2 and len(landed) == 1
    with open(f"{d}/in/2008_data.csv", "a", encoding="utf-8") as fh:
        fh.write("2008,2,10,6,830,830,1000,1010,UA,7,N1,100,100,80,4,-2,JFK,BOS,187,4,12,0,,0,NA,NA,NA,NA,NA\n")
    assert run(2008, partitions=3) == 3 and len(landed) == 2
    jobs.write_manifest(spark, f"{d}/stage", {})
    assert run(2008) == 3 and len(landed) == 3
    assert spark.read.parquet(f"{d}/fact2").count() == 3
    assert _listable(spark, f"{d}/stage") and not _listable(spark, f"{d}/nothing-here")


def test_cli_stream_lands_new_files_only(spark, capsys):
    d = tempfile.mkdtemp(prefix="flightmart-stream-")
    row = "2007,1,2,3,900,900,1100,1105,AA,12,N1,100,120,85,3,3,SFO,LAX,337,5,10,0,,0,NA,NA,NA,NA,NA\n"
    _write(f"{d}/in/2007/part-0.csv", HEADER + row)
    args = ["stream", "--source", f"{d}/in/*/", "--stage", f"{d}/stage", "--checkpoint", f"{d}/ckpt"]
    assert main(args) == 0
    _write(f"{d}/in/2008/part-0.csv", HEADER + row.replace("2007,", "2008,", 1))
    assert main(args) == 0
    staged = spark.read.parquet(f"{d}/stage")
    assert sorted(r.Year for r in staged.collect()) == ["2007", "2008"]
    assert "CarrierDelay" not in staged.columns


def test_cli_increments_versions_and_drift(spark, capsys):
    from flightmart.sinks import read_snapshot, snapshot_versions

    d = tempfile.mkdtemp(prefix="flightmart-increment-")
    row = "2007,1,2,3,900,900,1100,1105,AA,12,N1,100,120,85,3,3,SFO,LAX,337,5,10,0,,0,NA,NA,NA,NA,NA\n"
    _write(f"{d}/in/2007_data.csv", HEADER + row)
    args = ["increment", "--source", f"{d}/in/*.csv", "--target", f"{d}/fact"]
    assert main(args) == 0 and main(args) == 0
    _write(f"{d}/in/2008_data.csv", HEADER + row + row.replace("2007,", "2008,", 1))
    assert main(args) == 0
    fact = read_snapshot(spark, f"{d}/fact")
    assert sorted(str(r.FlightDate) for r in fact.collect()) == ["2007-01-02", "2007-01-02", "2008-01-02"]
    assert snapshot_versions(spark, f"{d}/fact") == [1, 2]
    full = ["flights", "--source", f"{d}/in", "--stage", f"{d}/stage", "--target", f"{d}/fact", "--first", "2007", "--last", "2007", "--snapshots"]
    assert main([*full, "--verify", "content"]) == 0
    assert read_snapshot(spark, f"{d}/fact").count() == 1 and fact.count() == 3
    names = HEADER.strip().split(",")
    _write(f"{d}/in/2009_data.csv", ",".join(names[::-1]) + "\n" + ",".join(row.strip().split(",")[::-1]) + "\n")
    assert main(["drift", "--source", f"{d}/in/*.csv"]) == 0
    assert "2009_data.csv Year moved 0 28" in capsys.readouterr().out
    assert main(["land", "--source", f"{d}/in", "--stage", f"{d}/all", "--first", "2007", "--last", "2009", "--by-name"]) == 0
    assert sorted(r.Year for r in spark.read.parquet(f"{d}/all").collect()) == ["2007", "2007", "2007", "2008"]
