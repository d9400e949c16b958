"""Events, intervals and values on a patient's time line, without all events of a patient in one task.

Three operators that need more than one equal date to meet:

- `events_in_windows`: events against any number of windows per patient, overlapping ones too. Windows
  are classed by length, the bins of a class are as wide as its longest window, so a window lies in two
  bins at most and an event in one per class. The join is on (patient, class, bin): a patient with very
  many events or windows is spread over bins.
- `eras`: intervals of one key merged to eras, gaps of up to some days bridged. A key is one window over
  its days: of a key with very many intervals a row per calendar day moves.
- `values_at`: the last value at or before a day, or the nearest one.

The last deals its rows by range of (key, day) and carries what earlier ranges leave open into later
ones: two small aggregates a range, no self-join. All merge such a patient's events per day before they
move them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.layers import materialize, release, small_tasks
from .cohort import rows_per_day


def _days(day: Column) -> Column:
    return F.unix_date(day).cast("bigint")


# --- events against windows ------------------------------------------------------------------


def events_in_windows(
    events: DataFrame, date_column: str, windows: DataFrame, start: str = "window_start", end: str = "window_end", **sums: Column
) -> DataFrame:
    """The windows (patient_id, `start`, `end`, and columns of their own), each with the dated events
    inside, both ends included: `events`, `first_event`, `last_event` and the given sums (null without
    events). Windows without a patient, without an end, or that end before they start hold none."""
    daily = rows_per_day(events.where("patient_id IS NOT NULL"), date_column, **{n: F.sum(c) for n, c in sums.items()})
    spans = windows.select(
        "patient_id", F.col(start).alias("_start"), F.col(end).alias("_end")
    ).where("patient_id IS NOT NULL AND _start <= _end").distinct()
    length = F.datediff("_end", "_start") + 1
    # Class k holds windows of up to 2**k days.
    spans = materialize(spans.withColumn("class", F.ceil(F.log2(length)).cast("int")), "window-spans")
    used = sorted(r["class"] for r in spans.select("class").distinct().collect())  # some 20 at most

    def bin_of(day, k):
        return F.expr(f"shiftright({day}, CAST({k} AS INT))")

    binned = spans.withColumns({"_low": _days(F.col("_start")), "_high": _days(F.col("_end"))}).withColumn(
        "bin", F.explode(F.sequence(bin_of("_low", "class"), bin_of("_high", "class")))
    )
    at = daily.withColumn("_day", _days(F.col(date_column)))
    classes = F.array(*[F.lit(k) for k in used]).cast("array<int>")
    dealt = at.withColumn("class", F.explode(classes)).withColumn("bin", bin_of("_day", "class"))
    inside = (F.col("_day") >= F.col("_low")) & (F.col("_day") <= F.col("_high"))
    met = (
        binned.join(dealt, ["patient_id", "class", "bin"])
        .where(inside)
        .groupBy("patient_id", "_start", "_end")
        .agg(
            F.sum("row_count").alias("events"),
            F.min(date_column).alias("first_event"),
            F.max(date_column).alias("last_event"),
            *[F.sum(n).alias(n) for n in sums],
        )
    )
    named = met.withColumnsRenamed({"_start": start, "_end": end})
    out = windows.join(named, ["patient_id", start, end], "left")
    return out.withColumn("events", F.coalesce("events", F.lit(0))).select(*windows.columns, "events", "first_event", "last_event", *sums)


def recurrent_index(events: DataFrame, codes: Column, date_column: str, gap_days: int) -> DataFrame:
    """(patient_id, index_date, index_number): the first day with a wanted event, and every later one
    that comes more than `gap_days` after the wanted day before it. Null patients have none."""
    days = events.where(codes & F.col(date_column).isNotNull() & F.col("patient_id").isNotNull())
    spans = days.select("patient_id", F.col(date_column).alias("start"), F.col(date_column).alias("end"))
    found = eras(spans, ["patient_id"], "start", "end", gap_days)
    return found.select(
        "patient_id",
        F.col("era_start").alias("index_date"),
        F.row_number().over(Window.partitionBy("patient_id").orderBy("era_start")).alias("index_number"),
    )


# --- eras ------------------------------------------------------------------------------------


def eras(intervals: DataFrame, keys: list[str], start: str, end: str, grace_days: int) -> DataFrame:
    """(keys, era_start, era_end, intervals, gap_days): intervals of one key merged where the next begins
    at most `grace_days` after the latest end so far; `gap_days` are days of an era that no interval
    covers. An interval without an end, or that ends before it starts, is one day; one without a start
    is left out. Null keys are keys. Hand in written intervals; they are read three times.

    The intervals move once, to their key. Only days of keys that own a large share of all rows are merged
    before, so that such a key brings a row per day; the others have few rows to bring."""
    begin, stop = _days(F.col(start)), _days(F.greatest(F.col(start), F.col(end)))
    spans = intervals.where(F.col(start).isNotNull()).select(
        *keys, begin.alias("_s"), F.coalesce(stop, begin).alias("_e"), F.lit(1).cast("bigint").alias("_n")
    )
    key = F.xxhash64(*keys)

    def per_day(rows):
        return rows.groupBy(*keys, "_s").agg(F.max("_e").alias("_e"), F.sum("_n").alias("_n"))

    along = Window.partitionBy(*keys).orderBy("_s")
    reached = F.max("_e").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.col("_reached").isNull() | (F.col("_s") > F.col("_reached") + grace_days)
    covered = F.greatest(F.lit(0), F.col("_e") - F.greatest(F.col("_s") - 1, F.coalesce("_reached", F.col("_s") - 1)))
    with small_tasks(intervals):
        frequent = _frequent(spans.select(key.alias("key")))
        # A frequent key's days are merged before they move with its key: it brings a row per day.
        days = materialize(per_day(spans.where(key.isin(frequent))), "era-days")
        rows = spans.where(~key.isin(frequent)).unionByName(days).repartition(*keys)
        pieces = (
            per_day(rows)
            .withColumn("_reached", reached)
            .withColumns({"_new": opens.cast("int"), "_covered": covered})
            .withColumn("_era", F.sum("_new").over(along))
            .groupBy(*keys, "_era")
            .agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"), F.sum("_n").alias("intervals"), F.sum("_covered").alias("_covered"))
        )
        whole = materialize(pieces, "era-pieces")
    release(days)
    return whole.select(
        *keys,
        F.date_from_unix_date(F.col("_s").cast("int")).alias("era_start"),
        F.date_from_unix_date(F.col("_e").cast("int")).alias("era_end"),
        "intervals",
        (F.col("_e") - F.col("_s") + 1 - F.col("_covered")).alias("gap_days"),
    )


FREQUENT = 1000


def _frequent(keys: DataFrame) -> list[int]:
    """The keys that own more than one row in FREQUENT, by a sketch that finds all of these: at most
    FREQUENT numbers. A key that is missed or added changes how rows travel, not what is made of them."""
    found = keys.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(key, {FREQUENT}, {10 * FREQUENT})").alias("top")).first()
    return [item["item"] for item in found["top"] or [] if item["count"] * FREQUENT > found["n"]]


# Fixed layout of the derived common-model tables: name -> (silver table, key, start, end, grace days).
ERAS = {
    "drug_era": ("medications", "code", "medication_start_date", "medication_stop_date", 30),
    "condition_era": ("conditions", "code", "condition_start_date", "condition_stop_date", 30),
    "observation_period": ("encounters", None, "encounter_start_date", "encounter_stop_date", 365),
}


def era_table(name: str, source: DataFrame) -> DataFrame:
    """A derived common-model table: exposure and condition eras (gaps of up to 30 days bridged) per
    person and code, observation periods (up to 365) per person."""
    _, code, start, end, grace = ERAS[name]
    found = eras(source, ["patient_id", *([code] if code else [])], start, end, grace)
    counted = {"drug_era": "drug_exposure_count", "condition_era": "condition_occurrence_count"}.get(name, "visit_count")
    prefix = {"drug_era": "drug", "condition_era": "condition"}.get(name)
    return found.select(
        F.col("patient_id").alias("person_source_value"),
        *([F.col(code).alias(f"{prefix}_source_value")] if code else []),
        F.col("era_start").alias(f"{name}_start_date"),
        F.col("era_end").alias(f"{name}_end_date"),
        F.col("intervals").alias(counted),
        "gap_days",
    )


# --- values at a day -------------------------------------------------------------------------


def values_at(
    values: DataFrame, points: DataFrame, keys: list[str], day: str, value: str, point_day: str, nearest: bool = False
) -> DataFrame:
    """The points (keys, `point_day`, and columns of their own), each with `value`: the last one of its
    key on or before the day, and `value_day`. With `nearest` the one with the fewest days to or from it,
    the earlier of two. Of several values of a day the largest counts; null values and days are none.
    Points without a key, a day or a value keep nulls. A key is all of `keys`, none null."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    seen = (
        values.where(known & F.col(day).isNotNull() & F.col(value).isNotNull())
        .groupBy(*keys, F.col(day).alias("_day"))
        .agg(F.max(value).alias("_value"))
        .select(*keys, "_day", F.struct("_day", F.col("_value").alias("_v")).alias("_seen"))
    )
    asked = points.where(known & F.col(point_day).isNotNull()).select(*keys, F.col(point_day).alias("_day")).distinct()
    # A day's value comes before its points, so it counts for them.
    both = seen.withColumn("_asks", F.lit(False)).unionByName(
        asked.withColumns({"_asks": F.lit(True), "_seen": F.lit(None).cast(seen.schema["_seen"].dataType)})
    )
    dealt = both.repartitionByRange(*keys, "_day", "_asks").withColumn("_part", F.spark_partition_id())
    rows = materialize(dealt, "values-in-order")

    along = Window.partitionBy(*keys).orderBy("_part")
    within = Window.partitionBy(*keys, "_part").orderBy("_day", "_asks")
    parts = rows.groupBy(*keys, "_part").agg(F.max("_seen").alias("_last"), F.min("_seen").alias("_first"))
    before = F.last("_last", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("_first", ignorenulls=True).over(along.rowsBetween(1, Window.unboundedFollowing))
    carried = parts.select(*keys, "_part", before.alias("_before"), after.alias("_after"))
    past = F.last("_seen", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, 0))
    found = rows.withColumn("_past", past)
    if nearest:
        found = found.withColumn("_next", F.first("_seen", ignorenulls=True).over(within.rowsBetween(0, Window.unboundedFollowing)))
    found = found.where("_asks").join(carried, [*keys, "_part"])
    best = F.coalesce("_past", "_before")
    if nearest:
        then = F.coalesce("_next", "_after")
        later = best.isNull() | (F.datediff(then["_day"], F.col("_day")) < F.datediff(F.col("_day"), best["_day"]))
        best = F.when(then.isNotNull() & later, then).otherwise(best)
    answered = found.select(*keys, F.col("_day").alias(point_day), best.alias("_best"))
    out = points.join(answered, [*keys, point_day], "left")
    return out.select(*points.columns, F.col("_best._v").alias("value"), F.col("_best._day").alias("value_day"))


def step_points(windows: DataFrame, days_per_step: int = 90) -> DataFrame:
    """(patient_id, step, point_day): the index date and every `days_per_step` days up to the end of
    follow-up."""
    steps = F.sequence(F.lit(0), F.floor(F.datediff("follow_up_end", "index_date") / days_per_step).cast("int"))
    return windows.select("patient_id", "index_date", F.explode(steps).alias("step")).select(
        "patient_id", "step", F.date_add("index_date", F.col("step") * days_per_step).alias("point_day")
    )
