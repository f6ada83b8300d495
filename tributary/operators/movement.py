"""Zones, visits and speeds.

Per (object, zone) and in time order, an object sighted inside a zone
after being outside (or at the start of a track) *enters*; sighted
outside after being inside it *leaves*.  At a leave, the visit time
``t = leave - entry`` gives ``round(length / t * 3.6, 1)`` km/h when
``min_t < t < max_t`` (both open), else 0.  The value holds from the leave
until the next entry and is 0 inside a zone.  An object unseen for more
than ``gap`` seconds is forgotten: its next sighting starts a new track.

Batch plan.  The state machine is a prefix scan; it is written as window
functions whose only cross-row needs are a lag and three running maxima
(track start, last entry, last leave).  To keep one busy object from
landing in one task, each (object, zone) sequence is cut into time
buckets: windows run per (object, zone, bucket), and what crosses bucket
borders (the previous row, the running maxima) comes from a per-bucket
summary table - one row per non-empty bucket - scanned per (object,
zone) and joined back on (object, zone, bucket).  The rows are shuffled
once; the join back finds them already partitioned by its keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.functions.geo import between_lines

__all__ = ["zone_table", "points_in_zones", "zone_speed", "ROAD_ZONES"]

# The two configured speed zones (location, name, line 1,
# line 2, real length in metres).
ROAD_ZONES = [
    ("Linkou", "H1_Linkou_north", ((67, 153), (346, 198)), ((177, 104), (346, 109)), 34.0),
    ("Zonghe", "H3_Zonghe_north", ((80, 108), (306, 115)), ((3, 136), (346, 143)), 24.0),
]

ZONE_SCHEMA = ("location string, zone_name string, a1x double, a1y double, a2x double, a2y double, "
               "b1x double, b1y double, b2x double, b2y double, length_m double")


def zone_table(spark: SparkSession, zones=ROAD_ZONES, location: str | None = None) -> DataFrame:
    """Zone config as a small table with the inside signs precomputed: the
    sign of line 2's midpoint against line 1 (``sa``) and of line 1's
    midpoint against line 2 (``sb``); 0 marks a degenerate zone.
    ``location`` puts every zone under one location name."""
    rows = [(location or loc, name, *map(float, (*a1, *a2, *b1, *b2)), float(length))
            for loc, name, (a1, a2), (b1, b2), length in zones]
    z = spark.createDataFrame(rows, ZONE_SCHEMA)
    mx_a, my_a = (F.col("a1x") + F.col("a2x")) / 2, (F.col("a1y") + F.col("a2y")) / 2
    mx_b, my_b = (F.col("b1x") + F.col("b2x")) / 2, (F.col("b1y") + F.col("b2y")) / 2
    sa = F.signum((F.col("a2x") - F.col("a1x")) * (my_b - F.col("a1y")) - (F.col("a2y") - F.col("a1y")) * (mx_b - F.col("a1x")))
    sb = F.signum((F.col("b2x") - F.col("b1x")) * (my_a - F.col("b1y")) - (F.col("b2y") - F.col("b1y")) * (mx_a - F.col("b1x")))
    z = z.withColumn("sa", sa).withColumn("sb", sb)
    return z.withColumn("sa", F.when(F.col("sb") == 0, 0.0).otherwise(F.col("sa"))) \
            .withColumn("sb", F.when(F.col("sa") == 0, 0.0).otherwise(F.col("sb")))


def points_in_zones(points: DataFrame, zones: DataFrame, x: str, y: str, location: str = "location") -> DataFrame:
    """Every point against every zone of its location, with the
    ``inside`` flag, joined on the location.  Spark broadcasts the zone table
    where its byte threshold admits it."""
    z = zones.select(location, F.struct(*[c for c in zones.columns if c != location]).alias("z"))
    j = points.join(z, on=location)
    return j.select(*points.columns, F.col("z.zone_name").alias("zone_name"), F.col("z.length_m").alias("length_m"),
                    between_lines(F.col(x), F.col(y), "z").alias("inside"))


def zone_speed(df: DataFrame, keys: list[str], t: str, tie: str, inside: str = "inside",
               length: str = "length_m", gap: float = 10.0, min_t: float = 0.1, max_t: float = 10.0,
               bucket_seconds: float = 300.0, materialize: str = "checkpoint") -> DataFrame:
    """Per row, the track start flag, entry/leave flags and speed.

    ``keys`` identify a sequence (object and zone), ``t`` is in seconds
    (double), ``tie`` orders equal times.

    Pass 1 (one shuffle by keys + time bucket): local lag, local flags for
    every row but the bucket's first, and local running maxima.  The
    result is checkpointed to the shared checkpoint folder (it is read
    twice and its lineage is cut).  A per-bucket summary (one row per
    non-empty bucket) resolves, with windows over buckets, the first row of
    each bucket and the carries (track start, last entry, last leave);
    joined back on (keys, bucket), pass 2 finishes every row locally."""
    K = list(keys)
    KB = [*K, "__bk"]
    c_t, c_in = F.col(t), F.col(inside)
    d = df.withColumn("__bk", F.floor(c_t / F.lit(bucket_seconds)).cast("long"))
    w = Window.partitionBy(*KB).orderBy(c_t, F.col(tie))
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lp_t, lp_in = F.lag(t).over(w), F.lag(inside).over(w)
    d = d.withColumn("__lp_t", lp_t).withColumn("__lp_in", lp_in) \
         .withColumn("__is_last", F.lead(t).over(w).isNull())
    first = F.col("__lp_t").isNull()
    loc_new = ~first & ((c_t - F.col("__lp_t")) > gap)
    loc_pit = ~first & ~loc_new & F.col("__lp_in")
    d = (d.withColumn("__first", first)
           .withColumn("__l_new", loc_new)
           .withColumn("__l_entry", ~first & c_in & ~loc_pit)
           .withColumn("__l_exit", ~first & ~c_in & loc_pit))
    d = d.withColumn("__l_en_run", F.max(F.when(F.col("__l_entry"), c_t)).over(run))
    d = d.withColumn("__l_ts_run", F.max(F.when(F.col("__l_new"), c_t)).over(run))
    if materialize == "checkpoint":
        from tributary.session import checkpoint_dir
        checkpoint_dir(d.sparkSession)
        d = d.checkpoint(eager=True)
    elif materialize == "persist":
        d = d.persist()

    # Per-bucket summary.
    ex_t = F.when(F.col("__l_exit"), c_t)
    summ = d.groupBy(*KB).agg(
        F.max(F.when(F.col("__first"), c_t)).alias("first_t"),
        F.max(F.when(F.col("__first"), c_in.cast("int"))).alias("first_in"),
        F.max(F.when(F.col("__is_last"), c_t)).alias("last_t"),
        F.max(F.when(F.col("__is_last"), c_in.cast("int"))).alias("last_in"),
        F.max(F.when(F.col("__l_new"), c_t)).alias("l_ts"),
        F.max(F.when(F.col("__l_entry"), c_t)).alias("l_en"),
        F.max(ex_t).alias("lx_t"),
        F.max_by(F.col("__l_en_run"), ex_t).alias("lx_en"),
        F.max_by(F.col("__l_ts_run"), ex_t).alias("lx_ts"),
        F.max(F.col(length)).alias("len"))
    wk = Window.partitionBy(*K).orderBy("__bk")
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("p_t", F.lag("last_t").over(wk)).withColumn("p_in", F.lag("last_in").over(wk))
    f_new = F.col("p_t").isNull() | ((F.col("first_t") - F.col("p_t")) > gap)
    f_pit = ~f_new & (F.col("p_in") == 1)
    summ = (summ.withColumn("f_new", f_new)
                .withColumn("f_entry", (F.col("first_in") == 1) & ~f_pit)
                .withColumn("f_exit", (F.col("first_in") == 0) & f_pit))
    b_ts = F.greatest(F.col("l_ts"), F.when(F.col("f_new"), F.col("first_t")))
    b_en = F.greatest(F.col("l_en"), F.when(F.col("f_entry"), F.col("first_t")))
    summ = summ.withColumn("b_ts", b_ts).withColumn("b_en", b_en)
    summ = summ.withColumn("c_ts", F.max("b_ts").over(before)).withColumn("c_en", F.max("b_en").over(before))

    def speed_of(dt):
        return F.when((dt > min_t) & (dt < max_t), F.bround(F.col("len") / dt * 3.6, 1)).otherwise(F.lit(0.0))

    # Last leave of the bucket (time, speed): a later row's leave uses the
    # entry seen before it in the bucket, else the first row's, else the
    # carried one; a leave on the first row uses the carried entry.
    f_en_t = F.when(F.col("f_entry"), F.col("first_t"))
    lx_entry = F.coalesce(F.col("lx_en"), f_en_t, F.col("c_en"))
    bx_t = F.coalesce(F.col("lx_t"), F.when(F.col("f_exit"), F.col("first_t")))
    bx_s = F.when(F.col("lx_t").isNotNull(), speed_of(F.col("lx_t") - lx_entry)) \
            .when(F.col("f_exit"), speed_of(F.col("first_t") - F.col("c_en")))
    summ = summ.withColumn("bx_t", bx_t).withColumn("bx_s", bx_s)
    summ = summ.withColumn("c_xt", F.max("bx_t").over(before)).withColumn("c_xs", F.max_by("bx_s", "bx_t").over(before))
    summ = summ.select(*KB, "p_t", "p_in", "c_ts", "c_en", "c_xt", "c_xs")

    # Pass 2: rows of a bucket with the resolved carries.
    j = d.join(summ, on=KB, how="left")
    new_track = F.when(F.col("__first"), F.col("p_t").isNull() | ((c_t - F.col("p_t")) > gap)) \
                 .otherwise(F.col("__l_new"))
    prev_in = F.when(F.col("__first"), F.col("p_in") == 1).otherwise(F.col("__lp_in"))
    j = j.withColumn("new_track", new_track)
    pit = ~F.col("new_track") & F.coalesce(prev_in, F.lit(False))
    j = j.withColumn("entry", c_in & ~pit).withColumn("exit", ~c_in & pit)
    w2 = Window.partitionBy(*KB).orderBy(c_t, F.col(tie))
    run2 = w2.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = j.withColumn("track_start", F.greatest(F.max(F.when(F.col("new_track"), c_t)).over(run2), F.col("c_ts")))
    j = j.withColumn("__last_entry", F.greatest(F.max(F.when(F.col("entry"), c_t)).over(run2), F.col("c_en")))
    dt = c_t - F.col("__last_entry")
    j = j.withColumn("exit_speed", F.when(F.col("exit"), F.when((dt > min_t) & (dt < max_t),
                                                                F.bround(F.col(length) / dt * 3.6, 1))
                                          .otherwise(F.lit(0.0))))
    x_t = F.when(F.col("exit"), c_t)
    j = j.withColumn("__lx_t", F.max(x_t).over(run2)).withColumn("__lx_s", F.max_by("exit_speed", x_t).over(run2))
    held_t = F.coalesce(F.col("__lx_t"), F.col("c_xt"))
    held_s = F.when(F.col("__lx_t").isNotNull(), F.col("__lx_s")).otherwise(F.col("c_xs"))
    speed = (F.when(c_in, F.lit(0.0))
              .when(held_t.isNotNull() & (held_t >= F.col("track_start")), held_s)
              .otherwise(F.lit(0.0)))
    j = j.withColumn("speed_kmh", speed)
    return j.select(*df.columns, "new_track", "entry", "exit", "track_start", "exit_speed", "speed_kmh")
