"""A plain-Python model of the cleaning rules, one row at a time.

Written from the rules in words, without Spark: a value is missing if it is
None or one of four tokens; whole numbers are read leniently; a date is what
year, month and day spell.
"""

from __future__ import annotations

import datetime
import re

TOKENS = {"null", "NULL", "NA", "NaN"}
NUMBER = re.compile(r"([+-]?)(?:(\d+)(?:\.\d*)?|\.\d+)")
FLAGGED = "DepTime ArrTime ActualElapsedTime AirTime ArrDelay DepDelay".split()
WHOLE = (
    "Year Month DayofMonth DayOfWeek DepTime CRSDepTime ArrTime CRSArrTime FlightNum ActualElapsedTime CRSElapsedTime "
    "AirTime ArrDelay DepDelay Distance TaxiIn TaxiOut Cancelled Diverted"
).split()


def missing(value: str | None) -> bool:
    return value is None or value in TOKENS


def whole(value: str | None) -> int | None:
    found = NUMBER.fullmatch(value.strip("".join(map(chr, range(33))))) if value is not None else None
    if not found:
        return None
    n = int(found[2] or 0) * (-1 if found[1] == "-" else 1)
    return n if -(2**31) <= n < 2**31 else None


def spelled_date(*parts: int | None) -> datetime.date | None:
    """The date of the parts that are there, two digits for month and day."""
    known = [str(p) if k == 0 else str(p).zfill(2)[:2] if p >= 0 else str(p)[:2].zfill(2) for k, p in enumerate(parts) if p is not None]
    text = re.fullmatch(r"(\d{4,7})(?:-(\d{1,2}))?(?:-(\d{1,2}))?", "-".join(known))
    try:
        return datetime.date(*(int(g or 1) for g in text.groups())) if text else None
    except ValueError:
        return None


def flight(row: dict[str, str | None]) -> dict | None:
    """The cleaned row, or None if it goes."""
    if any(missing(row[c]) for c in ("TaxiIn", "TaxiOut", "CRSElapsedTime")):
        return None
    out = dict(row)
    flagged = any(missing(row[c]) for c in FLAGGED)
    tail = "Unknown Tail Number" if missing(row["TailNum"]) or row["TailNum"] == "UNKNOW" else row["TailNum"]
    out["TailNum"] = "".join(c for c in tail if " " <= c <= "~")
    for late, planned in (("DepTime", "CRSDepTime"), ("ArrTime", "CRSArrTime"), ("ActualElapsedTime", "CRSElapsedTime")):
        if missing(row[late]):
            out[late] = row[planned]
    for delay in ("DepDelay", "ArrDelay"):
        if missing(row[delay]):
            out[delay] = "0"
    if missing(row["AirTime"]):
        times = [whole(out[c]) for c in ("ActualElapsedTime", "TaxiIn", "TaxiOut")]
        air = None if None in times else (times[0] - times[1] - times[2] + 2**31) % 2**32 - 2**31
        out["AirTime"] = None if air is None else str(air)
    for c in WHOLE:
        out[c] = whole(out[c])
    return out | {"MissingData": int(flagged), "FlightDate": spelled_date(out["Year"], out["Month"], out["DayofMonth"])}


#: The published corrections of city and state by airport code.
def airport(row: dict, corrections: dict[str, tuple[str, str]]) -> dict:
    out = {{"iata": "IATA", "lat": "latitude", "long": "longitude"}.get(k, k): v for k, v in row.items()}
    if out["IATA"] in corrections:
        out["city"], out["state"] = corrections[out["IATA"]]
    return out


def plane(row: dict) -> dict | None:
    if row["type"] is None:
        return None
    day = None
    if found := re.fullmatch(r"(\d\d)/(\d\d)/(\d{4})", row["issue_date"] or ""):
        try:
            day = datetime.date(int(found[3]), int(found[1]), int(found[2]))
        except ValueError:
            day = None
    return row | {"issue_date": day, "year": whole(row["year"])}


def variable(row: dict) -> dict | None:
    if row["Variable descriptions"] is None:
        return None
    return {{"_c1": "Name", "_c2": "Description"}.get(k, k): v for k, v in row.items()}
