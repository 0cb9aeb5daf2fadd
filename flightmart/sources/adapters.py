"""Dirty flight-shaped tables derived from the generated benchmark tables.

The benchmark tables hold clean typed values; these projections turn them
into the raw shapes the cleaning jobs expect (all-string flights with the
four missing tokens, NULLs, ``UNKNOW`` and non-ASCII tail numbers, a
decimal in an integer column; lookups with NaN, NULL and token values).

Each projection is one SQL text that runs unchanged in Spark and in
DuckDB (the test oracle), apart from identifier quoting.  Every one reads
a table that grows with the scale factor, one output row per input row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import compile_wide_stages

RAW_FLIGHTS_SQL = """
SELECT CAST(year(l_shipdate) AS STRING) AS Year, CAST(month(l_shipdate) AS STRING) AS Month,
  CAST(dayofmonth(l_shipdate) AS STRING) AS DayofMonth, CAST(l_orderkey % 7 + 1 AS STRING) AS DayOfWeek,
  CASE WHEN k % 11 = 0 THEN 'NA' WHEN k % 101 = 0 THEN NULL ELSE CAST(k % 2400 AS STRING) END AS DepTime,
  CAST(l_partkey % 2400 AS STRING) AS CRSDepTime,
  CASE WHEN k % 13 = 0 THEN 'NaN' ELSE CAST((k + 90) % 2400 AS STRING) END AS ArrTime,
  CAST((l_partkey + 95) % 2400 AS STRING) AS CRSArrTime,
  concat('C', CAST(l_suppkey % 20 AS STRING)) AS UniqueCarrier, CAST(l_partkey AS STRING) AS FlightNum,
  CASE WHEN k % 17 = 0 THEN 'UNKNOW' WHEN k % 19 = 0 THEN 'NA' WHEN k % 23 = 0 THEN NULL
       WHEN k % 29 = 0 THEN concat('Né', CAST(l_suppkey AS STRING)) WHEN k % 31 = 0 THEN 'éé'
       ELSE concat('N', CAST(l_suppkey AS STRING)) END AS TailNum,
  CASE WHEN k % 37 = 0 THEN 'null' WHEN k % 41 = 0 THEN '95.5' ELSE CAST(60 + k % 200 AS STRING) END AS ActualElapsedTime,
  CASE WHEN k % 43 = 0 THEN 'NA' ELSE CAST(65 + l_partkey % 200 AS STRING) END AS CRSElapsedTime,
  CASE WHEN k % 7 = 0 THEN 'NA' ELSE CAST(40 + k % 180 AS STRING) END AS AirTime,
  CASE WHEN k % 47 = 0 THEN 'NULL' ELSE CAST(k % 60 - 20 AS STRING) END AS ArrDelay,
  CASE WHEN k % 53 = 0 THEN NULL ELSE CAST(k % 45 - 10 AS STRING) END AS DepDelay,
  concat('A', CAST(l_suppkey % 25 AS STRING)) AS Origin, concat('A', CAST(l_partkey % 25 AS STRING)) AS Dest,
  CAST(100 + l_partkey AS STRING) AS Distance,
  CASE WHEN k % 59 = 0 THEN 'NA' ELSE CAST(k % 15 AS STRING) END AS TaxiIn,
  CASE WHEN k % 61 = 0 THEN NULL ELSE CAST(k % 25 AS STRING) END AS TaxiOut,
  CASE WHEN k % 50 = 0 THEN '1' ELSE '0' END AS Cancelled,
  CASE WHEN k % 50 = 0 THEN 'A' ELSE NULL END AS CancellationCode,
  CASE WHEN k % 70 = 0 THEN '1' ELSE '0' END AS Diverted,
  'NA' AS CarrierDelay, 'NA' AS WeatherDelay, 'NA' AS NASDelay, 'NA' AS SecurityDelay, 'NA' AS LateAircraftDelay
FROM (SELECT *, l_orderkey + l_linenumber AS k FROM {lineitem}) t
"""

# Airports: the first twelve supplier keys carry the codes that the airport
# override mapping knows; the first city/state values hold tokens there.
RAW_AIRPORTS_SQL = """
SELECT CASE s_suppkey WHEN 1 THEN 'CLD' WHEN 2 THEN 'HHH' WHEN 3 THEN 'ROR' WHEN 4 THEN 'YAP' WHEN 5 THEN 'MIB' WHEN 6 THEN 'MQT'
            WHEN 7 THEN 'RCA' WHEN 8 THEN 'RDR' WHEN 9 THEN 'ROP' WHEN 10 THEN 'SCE' WHEN 11 THEN 'SKA' WHEN 12 THEN 'SPN'
            ELSE concat('A', CAST(s_suppkey AS STRING)) END AS iata,
  s_name AS airport,
  CASE WHEN s_suppkey < 4 OR s_suppkey % 11 = 0 THEN 'NA' WHEN s_suppkey % 13 = 0 THEN NULL
       ELSE concat('City', CAST(s_suppkey % 97 AS STRING)) END AS city,
  CASE WHEN s_suppkey < 4 THEN 'NA' WHEN s_suppkey % 17 = 0 THEN 'NaN'
       ELSE concat('S', CAST(s_nationkey AS STRING)) END AS state,
  CASE WHEN s_suppkey % 19 = 0 THEN NULL ELSE 'USA' END AS country,
  CASE WHEN s_suppkey % 7 = 0 THEN CAST('NaN' AS DOUBLE) WHEN s_suppkey % 5 = 0 THEN NULL
       ELSE CAST(s_suppkey % 90 AS DOUBLE) * 0.5 END AS lat,
  CASE WHEN s_suppkey % 23 = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(s_nationkey AS DOUBLE) * -2.5 END AS long
FROM {supplier}
"""

RAW_CARRIERS_SQL = """
SELECT CASE WHEN c_custkey % 50 = 5 THEN 'NA' WHEN c_custkey % 50 = 8 THEN NULL
            ELSE concat('C', CAST(c_custkey % 1000 AS STRING)) END AS Code,
  CASE WHEN c_custkey % 31 = 0 THEN 'NULL' ELSE c_name END AS Description
FROM {customer}
"""

RAW_PLANES_SQL = """
SELECT concat('N', CAST(p_partkey AS STRING)) AS tailnum,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_type END AS type,
  CASE WHEN p_partkey % 7 = 0 THEN 'None' WHEN p_partkey % 11 = 0 THEN NULL
       WHEN p_partkey % 17 = 0 THEN '2/3/1999'
       ELSE concat(lpad(CAST(p_partkey % 12 + 1 AS STRING), 2, '0'), '/',
                   lpad(CAST(p_partkey % 28 + 1 AS STRING), 2, '0'), '/',
                   CAST(1980 + p_partkey % 28 AS STRING)) END AS issue_date,
  p_brand AS model,
  CASE WHEN p_partkey % 7 = 0 THEN 'None' WHEN p_partkey % 29 = 0 THEN '1999.0'
       ELSE CAST(1956 + p_partkey % 50 AS STRING) END AS year
FROM {part}
"""

RAW_VARIABLES_SQL = """
SELECT CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(p_partkey AS INT) END AS `Variable descriptions`,
  p_name AS _c1, concat('about ', p_type) AS _c2
FROM {part}
"""

# adapter name -> (SQL text, the benchmark table it reads)
ADAPTERS: dict[str, tuple[str, str]] = {
    "raw_flights": (RAW_FLIGHTS_SQL, "lineitem"),
    "raw_airports": (RAW_AIRPORTS_SQL, "supplier"),
    "raw_carriers": (RAW_CARRIERS_SQL, "customer"),
    "raw_planes": (RAW_PLANES_SQL, "part"),
    "raw_variables": (RAW_VARIABLES_SQL, "part"),
}


def adapter(spark: SparkSession, sf_dir: str, name: str, deal: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The dirty table ``name`` over the benchmark tables in ``sf_dir``, whose rows
    ``deal`` may partition anew before they are widened."""
    compile_wide_stages(spark)
    text, table = ADAPTERS[name]
    source = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    return spark.sql(text, **{table: deal(source) if deal else source})


def adapter_sql(name: str) -> str:
    """The same projection as DuckDB text over a registered table view."""
    text, table = ADAPTERS[name]
    return text.format(**{table: table}).replace("`", '"')


def year_span(raw: DataFrame, year: str = "Year") -> tuple[int, int]:
    """First and last year of the rows; a row without a year belongs to no yearly file, so it raises."""
    at = F.col(year).try_cast("int")
    first, last, lost = raw.agg(F.min(at), F.max(at), F.count_if(at.isNull())).first()
    if lost or first is None:
        raise ValueError(f"{lost} rows without a year")
    return first, last


def raw_flights(spark: SparkSession, sf_dir: str, deal: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    return adapter(spark, sf_dir, "raw_flights", deal)


def raw_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter(spark, sf_dir, "raw_airports")


def raw_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter(spark, sf_dir, "raw_carriers")


def raw_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter(spark, sf_dir, "raw_planes")


def raw_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter(spark, sf_dir, "raw_variables")
