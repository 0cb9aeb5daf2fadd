"""Random dirty flights: the job equals a plain-Python model of its rules."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flightmart.plans import clean_flights
from flightmart.plans.jobs import DROPPED_COLUMNS
from row_model import flight

COLUMNS = [
    "Year", "Month", "DayofMonth", "DayOfWeek", "DepTime", "CRSDepTime", "ArrTime", "CRSArrTime",
    "UniqueCarrier", "FlightNum", "TailNum", "ActualElapsedTime", "CRSElapsedTime", "AirTime",
    "ArrDelay", "DepDelay", "Origin", "Dest", "Distance", "TaxiIn", "TaxiOut", "Cancelled",
    "CancellationCode", "Diverted", "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay",
    "LateAircraftDelay",
]

# dirt the jobs meet: tokens, NULL, near-tokens, padding, decimals, signs, overflow, junk, non-ASCII
DIRTY = st.one_of(
    st.none(),
    st.sampled_from(["null", "NULL", "NA", "NaN", "nan", "None", "", " NA ", "UNKNOW", "éé", "Né1"]),
    st.sampled_from(["95.5", "-3.9", ".5", "12.", " 7 ", "+4", "1e3", "2147483647", "-2147483648", "99999999999"]),
    st.integers(-30, 2500).map(str),
)
YEAR = st.one_of(st.sampled_from(["2000", "2008", " 2004 ", "NA", "20x8"]), st.none())
MONTH = st.one_of(st.integers(0, 13).map(str), st.sampled_from(["NA", "1.0"]), st.none())
DAY = st.one_of(st.integers(0, 32).map(str), st.sampled_from(["NA", "07"]), st.none())


@st.composite
def flight_rows(draw):
    row = {c: draw(DIRTY) for c in COLUMNS}
    row["Year"], row["Month"], row["DayofMonth"] = draw(YEAR), draw(MONTH), draw(DAY)
    return tuple(row[c] for c in COLUMNS)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(flight_rows(), min_size=1, max_size=30))
def test_job_equals_row_model(spark, rows):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS))
    ours = clean_flights(df, skip_null_date_parts=True)
    kept = [dict(zip(COLUMNS, r)) for r in rows]
    model = [m for r in kept if (m := flight({c: v for c, v in r.items() if c not in DROPPED_COLUMNS}))]
    assert sorted(repr([r[c] for c in ours.columns]) for r in ours.collect()) == sorted(repr([m[c] for c in ours.columns]) for m in model)
