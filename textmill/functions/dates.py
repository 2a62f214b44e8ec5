"""Dates that are partly known, calendars, durations, coordinates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = ("day", "month", "year")


def _full(c: Column) -> Column:
    """The first day of a strict date, month or year, if the calendar has it."""
    padded = F.when(c.rlike(r"^[0-9]{4}$"), F.concat(c, F.lit("-01-01"))).when(c.rlike(r"^[0-9]{4}-[0-9]{2}$"), F.concat(c, F.lit("-01"))).when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), c)
    return padded.try_cast("date")


def parse_partial(c: Column) -> Column:
    """(year, precision) of a date text: day, month, year, range (a/b with both real), other, or empty for blank."""
    s = F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", "")
    both = F.split(s, "/")
    precision = (
        F.when(s == "", F.lit(""))
        .when(_full(s).isNotNull(), F.when(F.length(s) == 10, F.lit("day")).when(F.length(s) == 7, F.lit("month")).otherwise(F.lit("year")))
        .when((F.size(both) == 2) & _full(F.get(both, F.lit(0))).isNotNull() & _full(F.get(both, F.lit(1))).isNotNull(), F.lit("range"))
        .otherwise(F.lit("other"))
    )
    year = F.when(precision.isin(*POINT, "range"), F.substring(s, 1, 4).try_cast("int"))
    return F.struct(year.alias("year"), precision.alias("precision"))


def point_year(c: Column) -> Column:
    """The year of a date known to the day, month or year; null for ranges and others."""
    p = parse_partial(c)
    return F.when(p["precision"].isin(*POINT), p["year"])


def bounds(c: Column) -> Column:
    """(low, high): a range gives its start and end, a point itself, others null."""
    p = parse_partial(c)["precision"]
    parts = F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", ""), "/")
    return F.struct(F.when(p.isin(*POINT, "range"), F.get(parts, F.lit(0))).alias("low"), F.when(p.isin(*POINT, "range"), F.element_at(parts, -1)).alias("high"))


def added_date(c: Column) -> Column:
    """The date part of an ISO timestamp."""
    return F.get(F.split(c, "T"), F.lit(0))


def strict_day(c: Column) -> Column:
    """A date from YYYY-MM-DD or the date part of an ISO timestamp; null for all else."""
    day = F.regexp_extract(F.coalesce(c, F.lit("")), r"^([0-9]{4}-[0-9]{2}-[0-9]{2})(?:T[0-9:.+Z-]*)?$", 1)
    return day.try_cast("date")


def day_status(c: Column) -> Column:
    """empty, converted, imprecise or invalid."""
    s = F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", "")
    return F.when(s == "", "empty").when(strict_day(s).isNotNull(), "converted").when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(T.*)?$"), "invalid").otherwise("imprecise")


#: The civil day on which the month count of the table begins: 1 Muharram 1343.
EPOCH = date(1924, 8, 1)


def month_starts(spark, lengths: list[int], first_year: int = 1343):
    """A month table (start, hijri_year, hijri_month) from the lengths of consecutive months, which come from a published calendar."""
    rows, day, year, month = [], EPOCH.toordinal(), first_year, 1
    for n in lengths:
        rows.append((date.fromordinal(day), year, month))
        day += n
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)
    return spark.createDataFrame(rows, "start date, hijri_year int, hijri_month int")


def umm_al_qura(spark, first_year: int = 1343, last_year: int = 1500):
    """The month table of the Umm al-Qura calendar, as the Java runtime ships it (1300 to 1600): a row a month, some two thousand in all."""
    calendar = spark.sparkContext._jvm.java.time.chrono.HijrahDate
    lengths, day = [], calendar.of(first_year, 1, 1)
    start = date.fromordinal(date(1970, 1, 1).toordinal() + day.toEpochDay())
    for year in range(first_year, last_year + 1):
        lengths += [calendar.of(year, month, 1).lengthOfMonth() for month in range(1, 13)]
    table = month_starts(spark, lengths, first_year)
    return table.withColumn("start", F.date_add("start", (start - EPOCH).days))


def tabular_hijri(day: Column) -> Column:
    """(hijri_year, hijri_month, hijri_day) in the arithmetic civil calendar (30-year cycle, leap years 2, 5, 7, 10, 13, 16, 18, 21, 24, 26, 29), by whole numbers alone. It differs by a day or so from calendars that rest on sightings or tables."""
    n = F.datediff(day, F.lit("0622-07-19").cast("date"))  # 1 Muharram 1, proleptic Gregorian
    year = F.floor((30 * n + 10646) / 10631)
    into = n - (354 * (year - 1) + F.floor((3 + 11 * year) / 30))
    # months of 30 and 29 days by turns: month m begins after (59 * (m - 1) + 1) / 2 days
    guess = F.least(F.lit(12), F.floor(into * 2 / 59) + 1)
    month = F.when(into < F.floor((59 * (guess - 1) + 1) / 2), guess - 1).otherwise(guess)
    month = F.when((month < 12) & (into >= F.floor((59 * month + 1) / 2)), month + 1).otherwise(month)
    return F.struct(year.cast("int").alias("hijri_year"), month.cast("int").alias("hijri_month"), (into - F.floor((59 * (month - 1) + 1) / 2) + 1).cast("int").alias("hijri_day"))


def to_hijri(days, months):
    """Adds hijri_year, hijri_month, hijri_day to rows with a date `day` from a month table: an as-of join. Months are numbered, and a day is looked up among the month that starts in its civil month and the two before; days before the first start or in impossible places give null. The month table has some thousand rows at most and is broadcast."""
    table = months.withColumn("key", F.year("start") * 12 + F.month("start"))
    keyed = days.withColumn("__row", F.monotonically_increasing_id()).withColumn("__key", F.explode_outer(F.array(*(F.year("day") * 12 + F.month("day") - k for k in range(3)))))
    hit = keyed.join(F.broadcast(table), (F.col("__key") == F.col("key")) & (F.col("start") <= F.col("day")), "left")
    cols = [c for c in days.columns]
    best = hit.groupBy("__row", *cols).agg(F.max(F.struct("start", "hijri_year", "hijri_month")).alias("m"))
    gap = F.datediff("day", F.col("m.start"))
    ok = gap < 30
    return best.select(*cols, F.when(ok, F.col("m.hijri_year")).alias("hijri_year"), F.when(ok, F.col("m.hijri_month")).alias("hijri_month"), F.when(ok, gap + 1).alias("hijri_day"))


def duration_seconds(c: Column) -> Column:
    """P[nD][T[nH][nM][nS]] as whole seconds, rounded half to even; null for empty and malformed texts."""
    pattern = r"^P(?:([0-9.]+)D)?(?:T(?:([0-9.]+)H)?(?:([0-9.]+)M)?(?:([0-9.]+)S)?)?$"
    part = lambda i: F.coalesce(F.regexp_extract(c, pattern, i).try_cast("double"), F.lit(0.0))
    return F.when(c.rlike(pattern) & c.rlike("[0-9]"), F.bround(part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4)).cast("long"))


def coordinates(c: Column) -> Column:
    """(lat, lng) of 'lat, lng' within range; nulls for all else, several pairs included."""
    parts = F.split(F.coalesce(c, F.lit("")), ",")
    lat, lng = (F.regexp_replace(F.get(parts, F.lit(i)), r"^\s+|\s+$", "").try_cast("double") for i in (0, 1))
    ok = (F.size(parts) == 2) & lat.between(-90, 90) & lng.between(-180, 180)
    return F.struct(F.when(ok, lat).alias("lat"), F.when(ok, lng).alias("lng"))
