from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from weekloom.functions import calendar, noise
from weekloom.sources import generator

DAYS = [date(2019, 1, 1) + timedelta(days=i) for i in range((date(2033, 1, 1) - date(2019, 1, 1)).days)]


def by_hand(d, weeks, mode):
    woy = d.isocalendar()[1]
    if mode == "nearest":
        days = min(((h - woy) % 52) * 7 for h in weeks)
    else:
        days = min([365, *[((h - woy) % 52) * 7 for h in weeks if (h - woy) % 52]])
    return (
        woy, d.month, (d.month - 1) // 3 + 1, (d.day - 1) // 7 + 1,
        int((d + timedelta(days=7)).month != d.month), int(woy in weeks), days,
    )


@pytest.mark.parametrize("weeks", [calendar.HOLIDAY_WEEKS, calendar.HOLIDAY_WEEKS_NEW_YEAR, (20,)])
@pytest.mark.parametrize("mode", ["nearest", "strict"])
def test_calendar_on_every_day(spark, weeks, mode):
    df = spark.createDataFrame([(d,) for d in DAYS], "d date")
    made = calendar.calendar_columns(F.col("d"), weeks, mode)
    rows = df.select("d", *[c.alias(n) for n, c in made.items()]).collect()
    assert all(tuple(r)[1:] == by_hand(r["d"], weeks, mode) for r in rows)


def test_noise_does_not_depend_on_partitions(spark):
    def draw(parts):
        df = spark.range(1000).repartition(parts)
        hashed = noise.digest(1, F.col("id"))
        made = df.select("id", noise.normal(hashed, 0).alias("z"), noise.uniform(hashed, 2).alias("u"))
        return sorted(map(tuple, made.collect()))

    assert draw(1) == draw(7)


def test_demonstration_data(spark):
    df = generator.generate_sales(spark)
    s = df.agg(
        F.count("*").alias("n"),
        F.countDistinct("store_id", "dept_id").alias("series"),
        F.min("weekly_sales").alias("low"),
        F.min("event_timestamp").alias("first"),
    ).first()
    assert (s["n"], s["series"]) == (65_520, 630)
    assert s["low"] >= 0 and s["first"].date() == date(2022, 1, 1)
    quiet = generator.generate_sales(spark, seed=None).select(
        "store_id", "dept_id", "event_timestamp", F.col("weekly_sales").alias("mean")
    )
    d = df.join(quiet, ["store_id", "dept_id", "event_timestamp"]).agg(
        F.avg(F.col("weekly_sales") - F.col("mean")), F.stddev(F.col("weekly_sales") - F.col("mean"))
    ).first()
    assert abs(d[0]) < 40 and abs(d[1] - 2000) < 40
    e = df.agg(F.min("fuel_price"), F.max("fuel_price"), F.avg("unemployment"), F.stddev("unemployment")).first()
    assert e[0] >= 3.0 and e[1] <= 3.5 and abs(e[2] - 5) < 0.02 and abs(e[3] - 0.5) < 0.02
