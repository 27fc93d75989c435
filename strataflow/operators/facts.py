"""Parts that fact tables are assembled from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from strataflow.functions.columns import micros
from strataflow.operators.changes import unmatched
from strataflow.session import materialize

DAYS_PER_TASK = 2_000_000
DAY_MICROS = 86_400_000_000
RUN_TYPE = T.ArrayType(T.StructType().add("desde", T.DateType()).add("hasta", T.DateType()))


def insert_only(batch: DataFrame, fact: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch whose key the fact does not hold yet."""
    return batch if fact is None else unmatched(batch, fact, keys)


def recurrence_flag(
    events: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    counts: Column,
    flag: str,
    days: int = 30,
) -> DataFrame:
    """Flag events preceded, on the same key, by a counted one in ``history``
    less than or exactly ``days`` earlier.

    Time is cut into steps of ``days``. A counted event earlier in the same
    step is always near enough, so the step's earliest one decides; from the
    step before only the latest one can be near enough. Two values per key and
    step therefore answer every event: they are pre-aggregated before the
    shuffle, and a hot key is spread over its steps. They are stored before the
    join, which leaves Spark free to split a step that is still hot.
    """
    width = days * DAY_MICROS
    spot = micros(F.col(at))
    step = ((spot - F.pmod(spot, F.lit(width))) / width).cast("long")
    none = F.lit(None).cast("long")
    marks = F.array(
        F.struct(step.alias("_step"), spot.alias("_first"), none.alias("_before")),
        F.struct((step + 1).alias("_step"), none.alias("_first"), spot.alias("_before")),
    )
    summary = (
        history.filter(counts & F.col(at).isNotNull() & F.col(key).isNotNull())
        .select(F.col(key), F.inline(marks))
        .groupBy(key, "_step")
        .agg(F.min("_first").alias("_first"), F.max("_before").alias("_before"))
    )
    summary = materialize(summary, "recurrence")
    near = (F.col("_first") < spot) | (F.col("_before") >= spot - F.lit(width))
    return (
        events.withColumn("_step", step)
        .join(summary, [key, "_step"], "left")
        .withColumn(flag, F.coalesce(near, F.lit(False)))
        .drop("_step", "_first", "_before")
    )


def averages(readings: DataFrame, session: str, measures: Sequence[str]) -> DataFrame:
    return readings.groupBy(session).agg(*(F.avg(m).alias(m) for m in measures))


def outside_ranges(ranges: Mapping[str, tuple]) -> Column:
    """True when any measure lies outside its range; NULL measures do not count."""
    tests = []
    for measure, (low, high) in ranges.items():
        if low is not None:
            tests.append(F.col(measure) < low)
        if high is not None:
            tests.append(F.col(measure) > high)
    return F.coalesce(reduce(or_, (F.coalesce(t, F.lit(False)) for t in tests)), F.lit(False))


def day_runs(days: DataFrame, key: str, day: str) -> DataFrame:
    """(key, desde, hasta): the days of each key as runs without a hole.

    Days of one run keep their distance from their rank, so that distance
    names the run (gaps and islands). Days without a key or a date are left out.
    """
    known = days.select(key, F.to_date(day).alias("_day")).dropna().distinct()
    rank = F.row_number().over(Window.partitionBy(key).orderBy("_day"))
    island = F.date_sub("_day", rank).alias("_island")
    return known.select(key, "_day", island).groupBy(key, "_island").agg(
        F.min("_day").alias("desde"), F.max("_day").alias("hasta")
    ).drop("_island")


def joined_runs(runs: DataFrame, key: str, name: str = "tramos") -> DataFrame:
    """(key, ``name``): the runs of each key as one sorted array, those that overlap or touch joined."""
    listed = runs.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("desde", "hasta"))).alias("_runs"))
    none = F.array().cast(RUN_TYPE)

    def take(done: Column, run: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.struct(last["desde"].alias("desde"), F.greatest(last["hasta"], run["hasta"]).alias("hasta"))
        touches = (F.size(done) > 0) & (run["desde"] <= F.date_add(last["hasta"], 1))
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))).otherwise(
            F.concat(done, F.array(run))
        )

    joined = F.when(F.size("_runs") > 1, F.aggregate(F.slice("_runs", 2, F.size("_runs")), F.slice("_runs", 1, 1), take))
    return listed.select(key, F.coalesce(joined, F.col("_runs"), none).alias(name))


def uncovered(first: Column, last: Column, runs: Column) -> Column:
    """The days from ``first`` to ``last`` that are in none of ``runs`` (sorted, apart), as runs."""
    runs = F.filter(F.coalesce(runs, F.array().cast(RUN_TYPE)), lambda r: (r["hasta"] >= first) & (r["desde"] <= last))
    begin = F.concat(F.array(first), F.transform(runs, lambda r: F.date_add(r["hasta"], 1)))
    end = F.concat(F.transform(runs, lambda r: F.date_sub(r["desde"], 1)), F.array(last))
    holes = F.zip_with(begin, end, lambda a, b: F.struct(a.alias("desde"), b.alias("hasta")))
    return F.filter(holes, lambda r: r["desde"] <= r["hasta"])


def daily_rows(
    intervals: DataFrame,
    visits: DataFrame,
    key: str,
    start: str,
    end: str,
    visit_day: str,
    day: str,
    as_of: date,
    loaded: DataFrame | None = None,
    most_days: int | None = None,
) -> DataFrame:
    """One row per interval and day, with the visits of that day beside it.

    Open intervals run to ``as_of``. ``most_days`` cuts every interval after so
    many days; by default none is cut.
    A day without a visit gives one row of NULLs, a day with several visits
    several rows. Days in ``loaded`` (key and ``tramos``, as ``joined_runs``
    gives them) are left out: an interval is first cut down to its holes.

    The day grain is produced last and never shuffled: the distinct days with a
    visit are gathered as one array of dates per interval, the days left over
    are exploded in place, and visits join the interval itself. ``intervals``
    is read three times: store it if it is costly.
    """
    last = F.coalesce(F.to_date(end), F.lit(as_of).cast("date"))
    if most_days is not None:
        last = F.least(last, F.date_add(F.to_date(start), most_days - 1))
    spans = (
        intervals.withColumn("_from", F.to_date(start))
        .withColumn("_to", last)
        .filter(F.col("_from") <= F.col("_to"))
    )
    if loaded is not None:
        held = loaded.select(key, F.col("tramos").alias("_tramos"))
        spans = spans.join(held, key, "left").select(
            *intervals.columns, F.inline(uncovered(F.col("_from"), F.col("_to"), F.col("_tramos"))).alias("_from", "_to")
        )
    seen = [c for c in visits.columns if c not in (key, visit_day)]
    dated = visits.select(key, F.to_date(visit_day).alias(day), *seen)
    columns = intervals.columns

    def gathered(rows: DataFrame, name: str) -> DataFrame:
        days = rows.filter(F.col(day).isNotNull())
        return days.groupBy(key).agg(F.collect_set(day).alias(name))

    # a task takes as many intervals as make a fair number of days
    days = spans.agg(F.sum(F.datediff("_to", "_from") + 1)).first()[0] or 0
    least = int(intervals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = spans.repartition(max(least, days // DAYS_PER_TASK), key)
    spread = spread.join(gathered(dated, "_visited"), key, "left")

    inside = F.col(day).between(F.col("_from"), F.col("_to"))
    with_visit = dated.join(spans, key).filter(inside)
    no_days = F.array().cast("array<date>")
    taken = F.coalesce("_visited", no_days)
    every_day = F.sequence("_from", "_to", F.expr("interval 1 day"))
    quiet = spread.select(*columns, F.explode(F.array_except(every_day, taken)).alias(day))
    return quiet.unionByName(with_visit.select(*columns, day, *seen), allowMissingColumns=True)
