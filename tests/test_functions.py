import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import one_column
from flightmart.functions import (
    MISSING_TOKENS,
    date_from_parts,
    is_missing,
    is_missing_num,
    parse_date,
    strip_non_ascii,
    to_int,
)
from flightmart.operators import int_difference


def _values(df, expr):
    return [r[0] for r in df.select(expr.alias("v")).collect()]


def test_tokens_are_exact(spark):
    vals = ["null", "NULL", "NA", "NaN", None, "nan", "na", "None", "", " NA ", "Null", "0"]
    got = _values(one_column(spark, vals), is_missing("s"))
    assert got == [True, True, True, True, True, False, False, False, False, False, False, False]


def test_is_missing_never_null(spark):
    got = _values(one_column(spark, [None, "x"]), is_missing("s"))
    assert None not in got


def test_is_missing_on_numbers_uses_text_form(spark):
    df = spark.createDataFrame([(float("nan"), 1), (None, None), (1.5, 0)], "d double, i int")
    assert _values(df, is_missing("d")) == [True, True, False]
    assert _values(df, is_missing("i")) == [False, True, False]


def test_custom_token_set(spark):
    df = one_column(spark, ["NA", "UNKNOW", None])
    assert _values(df, is_missing("s", ())) == [False, False, True]
    assert _values(df, is_missing("s", MISSING_TOKENS + ("UNKNOW",))) == [True, True, True]


def test_is_missing_num(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (0.0,)], "d double")
    assert _values(df, is_missing_num("d")) == [True, True, False]


INT_CASES = {
    "12": 12, " 12 ": 12, "\t3\n": 3, "95.5": 95, "-95.9": -95, "12.": 12, ".5": 0, ".": 0,
    "-.": 0, "+7": 7, "007": 7, "1e3": None, "NA": None, "": None, " ": None, "+": None, "-": None,
    "0x10": None, "1_000": None, "1.2.3": None, "2147483647": 2147483647, "2147483648": None,
    "-2147483648": -2147483648, "99999999999": None, "１２": None, "1 2": None,
}


def test_to_int_cases(spark):
    keys = list(INT_CASES) + [None]
    got = _values(one_column(spark, keys), to_int("s"))
    assert dict(zip(keys, got)) == {**INT_CASES, None: None}


def test_to_int_equals_lenient_cast(spark, ansi_off):
    keys = list(INT_CASES)
    df = one_column(spark, keys)
    assert _values(df, to_int("s")) == _values(df, F.col("s").cast("int"))


@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="0123456789.+- e\t", max_size=7), min_size=1, max_size=40))
def test_to_int_property(spark, values):
    """Under ANSI off, a plain cast and ``to_int`` agree on any short text."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = one_column(spark, values)
        rows = df.select(to_int("s").alias("a"), F.col("s").cast("int").alias("b")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert [r.a for r in rows] == [r.b for r in rows]


def test_int_difference_wraps_like_32_bit(spark, ansi_off):
    df = spark.createDataFrame(
        [("2147483647", "-1", "0"), ("-2147483648", "1", "0"), ("10", "3", "2"), ("NA", "1", "1"), ("95.5", "5", "0")],
        "a string, b string, c string",
    )
    ours = _values(df, int_difference("a", "b", "c"))
    lenient = _values(df, F.col("a").cast("int") - F.col("b").cast("int") - F.col("c").cast("int"))
    assert ours == lenient == [-2147483648, 2147483647, 5, None, 90]


def test_strip_non_ascii(spark):
    got = _values(one_column(spark, ["Né1", "éé", None, "~ok ", "tab\there", "a😀b"]), strip_non_ascii("s"))
    assert got == ["N1", "", None, "~ok ", "tabhere", "ab"]


def test_parse_date(spark):
    vals = ["02/03/1999", "2/3/1999", "None", "02/30/1999", None, "1999-02-03"]
    got = _values(one_column(spark, vals), parse_date("s"))
    assert got == [datetime.date(1999, 2, 3), None, None, None, None, None]


def test_date_from_parts(spark):
    df = spark.createDataFrame(
        [(2008, 1, 5), (2008, None, 5), (2008, 1, None), (2008, 2, 30), (2008, 123, 5)],
        "y int, m int, d int",
    )
    strict = _values(df, date_from_parts("y", "m", "d"))
    assert strict == [datetime.date(2008, 1, 5), None, None, None, datetime.date(2008, 12, 5)]
    lenient = _values(df, date_from_parts("y", "m", "d", skip_null_parts=True))
    # joining only present parts: "2008-05" and "2008-01" are read as the 1st of the month
    assert lenient[:3] == [datetime.date(2008, 1, 5), datetime.date(2008, 5, 1), datetime.date(2008, 1, 1)]


def test_name_and_column_paths_agree(spark):
    """Names build SQL text (one JVM call); Columns use the Column API."""
    keys = list(INT_CASES) + [None]
    df = one_column(spark, keys + ["NA", "null"])
    by_name = _values(df, to_int("s"))
    by_col = _values(df, to_int(F.col("s")))
    assert by_name == by_col
    assert _values(df, is_missing("s")) == _values(df, is_missing(F.col("s")))
    d = spark.createDataFrame([("2147483647", "-1", "0"), ("9", "NA", "1"), (" 8.9", "1", ".")], "a string, b string, c string")
    assert _values(d, int_difference("a", "b", "c")) == _values(d, int_difference(F.col("a"), F.col("b"), F.col("c")))


def test_parse_date_guard_keeps_results(spark):
    vals = ["02/03/1999", " 02/03/1999", "None", "NA", None, "12/31/2000", "x2/03/1999"]
    df = one_column(spark, vals)
    guarded = _values(df, parse_date("s"))
    plain = _values(df, F.try_to_date(F.col("s"), "MM/dd/yyyy"))
    assert guarded == plain
    months = one_column(spark, ["Feb 03 1999", "None"])
    assert _values(months, parse_date("s", "MMM dd yyyy")) == [datetime.date(1999, 2, 3), None]
