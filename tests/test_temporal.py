import datetime as dt
import math

from pyspark.sql import functions as F

from stellate.functions.temporal import date_time, date_to_julian, julian_to_date, week_of_month
from stellate.operators.dims import build_dates, calendar_size, date_sequence


def test_hhmm_edge_times(spark):
    rows = [("1305",), ("0000",), ("5",), ("905",), ("2400",), ("130559",), ("",), (None,)]
    df = spark.createDataFrame(rows, "t string").withColumn("d", F.lit("1995-03-04").cast("date"))
    out = {r["t"]: r["ts"] for r in df.select("t", date_time("d", "t").cast("string").alias("ts")).collect()}
    assert out["1305"] == "1995-03-04 13:05:00"
    assert out["0000"] == "1995-03-04 00:00:00"
    assert out["5"] == "1995-03-04 05:00:00"
    for bad in ("905", "2400", "130559", "", None):
        assert out[bad] is None, bad


def test_julian_round_trip_and_nulls(spark):
    jds = [2448622.5, 2440587.5, 2448622.0, 2451544.49, 2451544.5, None]
    df = spark.createDataFrame([(j,) for j in jds], "jd double")
    got = [r["d"] for r in df.select(julian_to_date(F.col("jd").cast("decimal(10,2)")).alias("d")).collect()]
    for j, d in zip(jds, got):
        if j is None:
            assert d is None
        else:
            want = dt.date(1970, 1, 1) + dt.timedelta(days=math.floor(j + 0.5) - 2440588)
            assert d == want, (j, d, want)
    assert got[0] == dt.date(1992, 1, 1)
    back = spark.createDataFrame([(dt.date(1992, 1, 1),)], "d date").select(
        date_to_julian("d", "decimal(10,2)").alias("j")).first()["j"]
    assert float(back) == 2448622.5


def _us_week_of_month(d: dt.date) -> int:
    first = d.replace(day=1)
    offset = (first.weekday() + 1) % 7          # Sunday = 0
    return (d.day + offset - 1) // 7 + 1


def test_week_of_month_matches_us_calendar(spark):
    days = date_sequence(spark, "1999-01-01", "2002-01-01")
    rows = days.select("date", week_of_month("date").alias("w")).collect()
    assert len(rows) == 1096
    for r in rows:
        assert r["w"] == str(_us_week_of_month(r["date"])), r


def test_calendar_dimension(spark):
    dates = build_dates(spark)
    n = calendar_size()
    assert n == 18262
    assert dates.count() == n + 1
    unknown = dates.filter(F.col("date_type") == "unknown").collect()
    assert len(unknown) == 1 and unknown[0]["date_dim_id"] == n + 1
    assert all(unknown[0][c] is None for c in dates.columns if c not in ("date_dim_id", "date_type"))
    first = dates.filter(F.col("date_dim_id") == 1).first()
    assert first["date_actual"] == dt.date(1990, 1, 1)
    assert first["day_name"] == "Monday" and first["day_of_week"] == 2
    assert first["month_name"] == "January" and first["month_name_abbreviated"] == "Jan"
    assert first["quarter_name"] == "First" and first["epoch"] == 631152000
    last = dates.filter(F.col("date_dim_id") == n).first()
    assert last["date_actual"] == dt.date(2039, 12, 31)
    assert last["epoch"] > 2**31           # BIGINT: the calendar runs past 2038
    types = dict(dates.dtypes)
    assert types["date_dim_id"] == "bigint" and types["week_of_month"] == "string"
