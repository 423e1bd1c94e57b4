"""Joins over time: the state that held at an instant, and intervals that overlap."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.functions.text import quoted

#: Rows of one range of time, on average, in an as-of join; a key with more of them is split over as many tasks.
ROWS_PER_RANGE = 1_000_000
#: Levels of an interval join are this many doublings apart.
LEVEL_STEP = 3


def instant(column: Column, kind: str) -> Column:
    """A time as a 64-bit integer: microseconds of a timestamp, days of a date, an integer as it is."""
    if kind == "timestamp":
        return F.unix_micros(column)
    if kind == "timestamp_ntz":  # by the clock, whatever the session's time zone
        since = (column - F.expr("timestamp_ntz'1970-01-01'")).cast("interval second").cast("decimal(24,6)")
        return (since * 1_000_000).cast("long")
    return F.unix_date(column) if kind == "date" else column.cast("long")


def _instant_of(df: DataFrame, name: str) -> Column:
    return instant(quoted(name), dict(df.dtypes)[name])


def asof_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, take: Mapping[str, str],
    strict: bool = True, rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Every row of ``left`` with columns of the latest row of ``right`` of the same ``by`` before its time.

    ``take`` maps new column names to columns of ``right``. With ``strict``, a state at the very same time does not count;
    of several states at one time, the greatest by the taken columns holds. Rows without a state, or with a NULL key or time,
    have NULLs; repeated rows stay.

    Both sides are sorted together and the last state is carried forward. Time is cut into ranges of equal length, as many as the
    rows need, and each range of a key is sorted by itself, so no task holds a whole key; what a range inherits comes from one
    row per key and range.
    """
    names, by = left.columns, list(by)
    place = [f"k{i}" for i in range(len(by))]
    state = F.struct(*[quoted(c).alias(f"v{i}") for i, c in enumerate(take.values())])
    kind = right.select(state.alias("s")).schema["s"].dataType
    after = 2 if strict else 0  # where a state stands among rows of its time
    rows = left.select(
        *[quoted(b).alias(p) for b, p in zip(by, place)], _instant_of(left, left_time).alias("t"), F.lit(1).alias("side"),
        F.struct(*map(quoted, names)).alias("row"), F.lit(None).cast(kind).alias("state"),
    )
    states = right.select(
        *[quoted(b).alias(p) for b, p in zip(by, place)], _instant_of(right, right_time).alias("t"), F.lit(after).alias("side"),
        F.lit(None).cast(rows.schema["row"].dataType).alias("row"), state.alias("state"),
    )
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*place, "t"]])
    both = rows.where(known).unionByName(states.where(known))
    span = both.agg(F.min("t").alias("low"), F.max("t").alias("high"), F.count(F.lit(1)).alias("n")).first()
    ranges = max(1, -(-span["n"] // rows_per_range))
    width = max(1, -(-((span["high"] or 0) - (span["low"] or 0) + 1) // ranges))
    both = both.withColumn("range", F.floor((F.col("t") - F.lit(span["low"] or 0)) / F.lit(width)))
    own = Window.partitionBy(*place, "range").orderBy("t", "side", "state").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("held", F.last("state", ignorenulls=True).over(own)).where(F.col("side") == 1)
    if ranges > 1:
        last = both.groupBy(*place, "range").agg(F.max(F.when(F.col("side") != 1, F.struct("t", "state"))).alias("last"))
        earlier = Window.partitionBy(*place).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        carried = last.select(*place, "range", F.last("last", ignorenulls=True).over(earlier)["state"].alias("carried"))
        found = found.join(carried, [*place, "range"], "left").withColumn("held", F.coalesce("held", "carried"))
    unknown = rows.where(~known).withColumn("held", F.lit(None).cast(kind))
    out = found.select("row", "held").unionByName(unknown.select("row", "held"))
    return out.select(
        *[F.col("row").getField(c).alias(c) for c in names], *[F.col("held").getField(f"v{i}").alias(c) for i, c in enumerate(take)]
    )


def _levels(df: DataFrame) -> list[int]:
    return [r[0] for r in df.select("level").distinct().collect()]  # at most 64 / LEVEL_STEP rows


def interval_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_bounds: tuple[str, str], right_bounds: tuple[str, str],
    prefix: str = "right_",
) -> DataFrame:
    """Every pair of rows with the same ``by`` whose closed intervals overlap; an instant is an interval of one point.

    Columns of ``right`` follow those of ``left`` under ``prefix``. Intervals with a NULL bound or key, or that end before they
    begin, meet nothing; repeated rows meet as often as they are there.

    Time is cut into buckets of several widths. An interval lies in at most two buckets as wide as itself, and there, and in the
    wider ones that intervals of this join need, it meets the others: a plain equi-join on key, width and bucket. A pair counts in
    the wider one's width only, and there in the first bucket that both lie in, so none comes twice and bounds are compared
    exactly.
    """
    by, sides = list(by), []
    for df, (first, last), tag in ((left, left_bounds, "l"), (right, right_bounds, "r")):
        rows = df.select(
            *[quoted(b).alias(f"k{i}") for i, b in enumerate(by)], _instant_of(df, first).alias(f"{tag}_start"),
            _instant_of(df, last).alias(f"{tag}_end"), F.struct(*map(quoted, df.columns)).alias(f"{tag}_row"),
        )
        rows = rows.where((F.col(f"{tag}_start") <= F.col(f"{tag}_end")))
        length = F.col(f"{tag}_end") - F.col(f"{tag}_start")
        bits = F.when(length > 0, F.length(F.bin(length))).otherwise(0)
        sides.append(rows.withColumn("level", (F.ceil(bits / F.lit(LEVEL_STEP)) * LEVEL_STEP).cast("int")))
    levels = sorted(set(_levels(sides[0]) + _levels(sides[1])))
    dealt = []
    for rows, tag in zip(sides, "lr"):
        meets = F.expr(
            f"flatten(transform(filter(array({','.join(map(str, levels)) or '0'}), w -> w >= level), w -> "
            f"transform(sequence(shiftright({tag}_start, w), shiftright({tag}_end, w)), b -> struct(w as width, b as bucket))))"
        )
        spread = rows.withColumnRenamed("level", f"{tag}_level").withColumn("level", F.col(f"{tag}_level"))
        spread = spread.withColumn("at", F.explode(meets)).drop("level")
        dealt.append(spread.select("*", "at.width", "at.bucket").drop("at"))
    met = dealt[0].join(dealt[1], [*[f"k{i}" for i in range(len(by))], "width", "bucket"])
    met = met.where(
        "l_start <= r_end and r_start <= l_end and width = greatest(l_level, r_level) "
        "and bucket = greatest(shiftright(l_start, width), shiftright(r_start, width))"
    )
    return met.select(
        *[F.col("l_row").getField(c).alias(c) for c in left.columns],
        *[F.col("r_row").getField(c).alias(f"{prefix}{c}") for c in right.columns],
    )
