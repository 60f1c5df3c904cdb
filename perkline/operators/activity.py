"""Per-employee activity metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perkline.functions.dates import epoch_day


def daily_activity(valid: DataFrame) -> DataFrame:
    """One row per employee and active day. Partial aggregation absorbs hot employees before the shuffle."""
    return valid.groupBy("employee_id", "activity_date").agg(
        F.count("activity_id").alias("activity_count"),
        F.sum("distance_km").alias("distance_km"),
        F.sum("duration_min").alias("duration_min"),
        F.max("process_date").alias("process_date"),
    )


def known_activity(valid: DataFrame) -> DataFrame:
    """One row per employee, active day and processing date; an activity without the latter is known on its day."""
    known = F.coalesce("process_date", "activity_date")
    return valid.groupBy("employee_id", "activity_date", known.alias("process_date")).agg(
        F.count("activity_id").alias("activity_count"),
        F.sum("distance_km").alias("distance_km"),
        F.sum("duration_min").alias("duration_min"),
    )


def trailing_intervals(daily: DataFrame, calendar: DataFrame, window_days: int, last_pos: int) -> DataFrame:
    """Trailing-window metrics as runs of snapshot positions with constant values.

    A metric only changes on an active day and on the day that activity leaves the window, so the
    work is per active day and not per employee and calendar day.

    Window length is ``span = window_days + 1`` days (both ends inclusive). Days are cut into blocks
    of ``span`` days; the window ending on day p covers the head of p's block (activity entered
    there) and the tail of the block before, which is the activity *leaving* later than p in p's own
    block. Head and tail are running aggregates from either end, so maxima need no rescans either.
    A partition is one employee, with at most two rows per calendar day.
    """
    span = window_days + 1
    day = epoch_day(F.col("activity_date"))
    measures = ["activity_count", "distance_km", "duration_min", "activity_date", "process_date"]
    entering = F.struct(
        day.alias("day"), F.col("date_pos").alias("pos"), F.lit(1).alias("entering"), *measures)
    leaving = F.struct(
        (day + span).alias("day"), F.col("expiry_pos").alias("pos"), F.lit(0).alias("entering"), *measures)
    points = (
        daily.join(F.broadcast(calendar), daily["activity_date"] == calendar["snapshot_date"])
        .select("employee_id", F.explode(F.array(entering, leaving)).alias("p"))
        .select("employee_id", "p.*")
        .withColumn("block", F.floor(F.col("day") / span).cast("int"))
    )

    whole = Window.partitionBy("employee_id").orderBy("block", "day", "entering")
    head = (Window.partitionBy("employee_id", "block").orderBy("day", "entering")
            .rowsBetween(Window.unboundedPreceding, 0))
    tail = (Window.partitionBy("employee_id", "block").orderBy(F.desc("day"), F.desc("entering"))
            .rowsBetween(Window.unboundedPreceding, -1))
    is_in, is_out = F.col("entering") == 1, F.col("entering") == 0

    def total(value):
        return (F.coalesce(F.sum(F.when(is_in, value)).over(head), F.lit(0))
                + F.coalesce(F.sum(F.when(is_out, value)).over(tail), F.lit(0)))

    def latest(value):
        return F.greatest(F.max(F.when(is_in, value)).over(head), F.max(F.when(is_out, value)).over(tail))

    runs = points.select(
        "employee_id", "pos", "entering", "activity_count", "distance_km", "duration_min",
        (F.row_number().over(whole) == 1).alias("is_first"),
        F.coalesce(F.lead("pos").over(whole), F.lit(last_pos + 1)).alias("next_pos"),
        total(F.col("activity_count")).alias("activity_count_12m"),
        total(F.lit(1)).alias("sport_days_count_12m"),
        latest(F.col("activity_date")).alias("last_activity_date"),
        latest(F.col("process_date")).alias("last_process_date"),
    )
    return runs.filter(F.col("pos") < F.col("next_pos"))


def _first_positions(days: DataFrame, calendar: DataFrame) -> DataFrame:
    """(known_on, enter_pos): the first calendar position on or after each day; days behind the last one drop out.

    Days and calendar have one row per day at most.
    """
    marks = days.select(F.col("known_on").alias("day"), F.lit(0).alias("is_date"), F.lit(None).cast("int").alias("pos")).unionByName(
        calendar.select(F.col("snapshot_date").alias("day"), F.lit(1).alias("is_date"), F.col("date_pos").alias("pos")))
    onwards = Window.orderBy("day", "is_date").rowsBetween(0, Window.unboundedFollowing)
    return marks.withColumn("enter_pos", F.first("pos", ignorenulls=True).over(onwards)).filter(
        "is_date = 0 and enter_pos is not null").select(F.col("day").alias("known_on"), "enter_pos")


def _tree_nodes(low: Column, high: Column, levels: int) -> Column:
    """The positions ``low..high`` as at most two nodes (level, number) per level of a binary tree over positions."""
    def step(state: Column, level: Column) -> Column:
        lo, hi, nodes = state["lo"], state["hi"], state["nodes"]
        left = F.when((lo <= hi) & (lo % 2 == 1), F.array(F.struct(level.alias("level"), lo.alias("number"))))
        right = F.when((lo <= hi) & (hi % 2 == 0) & ~((lo == hi) & (lo % 2 == 1)),
                       F.array(F.struct(level.alias("level"), hi.alias("number"))))
        none = F.array().cast("array<struct<level:int,number:int>>")
        return F.struct(
            F.floor((lo + 1) / 2).cast("int").alias("lo"), F.floor((hi - 1) / 2).cast("int").alias("hi"),
            F.concat(nodes, F.coalesce(left, none), F.coalesce(right, none)).alias("nodes"))

    start = F.struct(low.cast("int").alias("lo"), high.cast("int").alias("hi"),
                     F.array().cast("array<struct<level:int,number:int>>").alias("nodes"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(levels)), start, step, lambda state: state["nodes"])


def known_intervals(known: DataFrame, calendar: DataFrame, window_days: int, last_pos: int) -> DataFrame:
    """``trailing_intervals`` with two time axes: an activity counts from the later of its day and its processing date.

    Rows of ``known_activity`` enter at the first snapshot on which they are known and leave with their day. Counts are
    running sums over the marks of an employee. Days leave in their own order, so the latest day that has entered is the last
    active one while anything counts. Processing dates do not, so each row hangs its date on the few tree nodes that
    make up its positions, and a position takes the largest date on its path. Work is per row and level of the
    tree, never per pair of rows.
    """
    levels = max(1, last_pos).bit_length()
    own = calendar.select("snapshot_date", "date_pos", "expiry_pos")
    rows = known.join(F.broadcast(own), known["activity_date"] == own["snapshot_date"]).withColumn(
        "known_on", F.greatest("activity_date", "process_date"))
    rows = rows.join(F.broadcast(_first_positions(rows.select("known_on").distinct(), calendar)), "known_on").filter(
        F.col("enter_pos") < F.col("expiry_pos"))
    entered = F.row_number().over(Window.partitionBy("employee_id", "activity_date").orderBy("enter_pos", "process_date")) == 1
    today = F.col("known_on") == F.col("activity_date")
    counted = rows.withColumn("day", entered.cast("int"))

    def mark(pos: str, sign: int) -> Column:
        first = [F.when(today, F.col(c)).alias(c) for c in ("activity_count", "distance_km", "duration_min")]
        blank = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("activity_count", "distance_km", "duration_min")]
        return F.struct(
            F.col(pos).alias("pos"), (sign * F.col("activity_count")).alias("counts"), (sign * F.col("day")).alias("days"),
            (F.col("activity_date") if sign > 0 else F.lit(None).cast("date")).alias("activity_date"),
            *(first if sign > 0 else blank))

    marks = counted.select("employee_id", F.explode(F.array(mark("enter_pos", 1), mark("expiry_pos", -1))).alias("m")).select(
        "employee_id", "m.*")
    points = marks.groupBy("employee_id", "pos").agg(
        F.sum("counts").alias("counts"), F.sum("days").alias("days"), F.max("activity_date").alias("activity_date"),
        *[F.sum(c).alias(c) for c in ("activity_count", "distance_km", "duration_min")])
    order = Window.partitionBy("employee_id").orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    runs = points.select(
        "employee_id", "pos", F.col("activity_count").isNotNull().cast("int").alias("entering"), "activity_count", "distance_km",
        "duration_min", (F.row_number().over(order) == 1).alias("is_first"),
        F.coalesce(F.lead("pos").over(order), F.lit(last_pos + 1)).alias("next_pos"),
        F.sum("counts").over(so_far).alias("activity_count_12m"), F.sum("days").over(so_far).alias("sport_days_count_12m"),
        F.max("activity_date").over(so_far).alias("last_activity_date"),
    ).filter(F.col("pos") <= last_pos)

    nodes = rows.select("employee_id", "process_date", F.explode(
        _tree_nodes(F.col("enter_pos"), F.col("expiry_pos") - 1, levels)).alias("node")).groupBy(
        "employee_id", "node.level", "node.number").agg(F.max("process_date").alias("process_date"))
    path = F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda level: F.struct(
        level.alias("level"), F.floor(F.col("pos") / F.pow(F.lit(2), level)).cast("int").alias("number")))
    latest = (
        runs.select("employee_id", "pos", F.explode(path).alias("node")).select("employee_id", "pos", "node.*")
        .join(nodes, ["employee_id", "level", "number"]).groupBy("employee_id", "pos")
        .agg(F.max("process_date").alias("last_process_date")))
    active = F.col("activity_count_12m") > 0
    return runs.join(latest, ["employee_id", "pos"], "left").withColumn(
        "last_activity_date", F.when(active, F.col("last_activity_date")))
