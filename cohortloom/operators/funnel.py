"""R-5 / R-6: order-free cumulative funnel by group and country.

A device reaches step k when it hit steps 1..k, in any time order. Each
device's hits are one bitmask (``bit_or`` of ``1 << step_no``), built by
a hash aggregate that combines map-side, so a device with a third of
all events still leaves each map task as one row. Reach at step k is
then "trailing ones of mask >> 1 >= ordinal of k", counted per (group, country,
mask) — a table of at most groups × countries × 2^steps rows — and
joined to the small step list. Steps are numbered densely per group
before they become bits, so gaps in ``step_no`` do no harm; more steps
than bits raise in either form of the step list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import schemas
from cohortloom.functions import dims
from cohortloom.functions import params as P
from cohortloom.operators import experiment as X
from cohortloom.plans.broadcast import dimension
from cohortloom.sources.events import between_times

MAX_STEPS = 62   # the bitmask is a bigint
COUNTRY_TABS = [dims.ALL_COUNTRIES, *(code for _, code in dims.FUNNEL_COUNTRY_CODES)]


def default_steps(screens: dict[str, str] | None = None) -> list[tuple]:
    """Sample step list for A and B from the named events: first open,
    successful sign-up, first-lesson event (group lesson ids), checkout
    start. Rows: (grp, step_no, step, event_name, lesson_ids, require_success).

    Screens have no event name by definition. ``screens`` names the events
    of those to count (keys of ``dims.SCREENS``); each becomes a step of its
    group after the step it follows there."""
    rows = []
    for grp, lessons in (("A", dims.LESSONS_A), ("B", dims.LESSONS_B)):
        steps = [
            ("first_open", dims.FIRST_OPEN, None, False),
            ("signup", dims.SIGNUP_RESULT, None, True),
            ("lesson_start", dims.LESSON_EVENT, [int(x) for x in lessons], False),
            ("checkout_start", dims.CHECKOUT_EVENT, None, False),
        ]
        for owner, screen, follows in dims.SCREENS:
            if owner == grp and screen in (screens or {}):
                # a screen whose predecessor is not counted stands after the sign-up
                names = [s[0] for s in steps]
                at = names.index(follows if follows in names else "signup") + 1
                steps.insert(at, (screen, screens[screen], None, False))
        rows += [(grp, n, *s) for n, s in enumerate(steps, 1)]
    unknown = set(screens or {}) - {s for _, s, _ in dims.SCREENS}
    if unknown:
        raise ValueError(f"unknown screens: {sorted(unknown)}")
    return rows


def steps_frame(spark: SparkSession, steps=None) -> DataFrame:
    """Step list (rows or a DataFrame) as a dimension with ``ord``, the
    dense ordinal of a step in its group."""
    if steps is None:
        steps = default_steps()
    too_many = f"a group has more than {MAX_STEPS} steps"
    if isinstance(steps, DataFrame):
        rank = F.dense_rank().over(Window.partitionBy("grp").orderBy("step_no"))
        checked = F.when(F.col("ord") <= MAX_STEPS, F.col("ord")).otherwise(F.raise_error(F.lit(too_many)).cast("int"))
        return steps.withColumn("ord", rank).withColumn("ord", checked)
    numbers = {g: sorted({r[1] for r in steps if r[0] == g}) for g in {r[0] for r in steps}}
    if any(len(n) > MAX_STEPS for n in numbers.values()):
        raise ValueError(too_many)
    fields = T.StructType([*schemas.FUNNEL_STEPS.fields, T.StructField("ord", T.IntegerType())])
    return dimension(spark, [(*r, numbers[r[0]].index(r[1]) + 1) for r in steps], fields)


def gaps_frame(spark: SparkSession, gaps=None) -> DataFrame:
    """Known tracking gaps (rows or a DataFrame) as a dimension."""
    return dimension(spark, dims.KNOWN_GAPS if gaps is None else gaps, schemas.KNOWN_GAPS)


def _trailing_ones(x: Column) -> Column:
    return F.bit_count(x.bitwiseAND(F.bitwise_not(x + F.lit(1))))


def depth(mask: Column) -> Column:
    """Number of consecutive steps reached from step 1."""
    return _trailing_ones(F.shiftright(mask, 1))


def step_masks(events: DataFrame, steps=None, event_names=None, cutoff=None) -> DataFrame:
    """(device, grp, mask): which steps of each group's list the device
    hit before ``cutoff``. ``event_names`` (literal) lets the name filter reach the scan;
    with a step list it is derived from it."""
    if event_names is None and not isinstance(steps, DataFrame):
        event_names = step_event_names(steps)
    steps = steps_frame(events.sparkSession, steps)
    ev = between_times(events, None, cutoff)
    if event_names:
        ev = ev.where(F.col("event_name").isin(list(event_names)))
    ev = ev.select("user_pseudo_id", "event_name",
                   P.param("lesson_id", "int_value").alias("lesson_id"),
                   P.is_success().alias("ok"))
    s = steps.select("grp", "ord", F.col("event_name").alias("s_event"), "lesson_ids", "require_success")
    cond = ((F.col("event_name") == F.col("s_event"))
            & (F.col("lesson_ids").isNull() | F.coalesce(F.array_contains("lesson_ids", F.col("lesson_id")),
                                                         F.lit(False)))
            & (~F.col("require_success") | F.col("ok")))
    return (ev.join(s, cond, "inner")
            .groupBy("user_pseudo_id", "grp")
            .agg(F.bit_or(F.expr("shiftleft(CAST(1 AS BIGINT), ord)")).alias("mask")))


def device_funnel(stable: DataFrame, masks: DataFrame) -> DataFrame:
    """Every stable device with its mask (0 when it hit nothing): the left
    join keeps assigned devices without step events countable."""
    return (stable.select("user_pseudo_id", "grp", "country_code", "app_version")
            .join(masks, ["user_pseudo_id", "grp"], "left")
            .select("user_pseudo_id", "grp", "country_code", "app_version",
                    F.coalesce(F.col("mask"), F.lit(0).cast("bigint")).alias("mask")))


def funnel_reach(devices: DataFrame, steps=None, by=("country_code",), all_label=dims.ALL_COUNTRIES,
                 with_all: bool = True, tabs=None) -> DataFrame:
    """(grp, <by>, step) -> assigned, reached (cumulative), hit (any order).

    ``tabs`` lists values of a single ``by`` column that every group shows,
    with zeros where it has no device.

    ``by`` columns get an extra "all" row from grouping sets that counts
    every device of the group (other and unknown countries included);
    ``grouping_id`` tells it apart from a null key.
    """
    by = list(by)
    if with_all:
        counts = (devices.groupingSets([["grp", *by, "mask"], ["grp", "mask"]], "grp", *by, "mask")
                  .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid")))
        counts = counts.select("grp", *[F.when(F.col("gid") > 0, F.lit(all_label)).otherwise(F.col(b)).alias(b)
                                        for b in by], "mask", "n")
    else:
        counts = devices.groupBy("grp", *by, "mask").agg(F.count(F.lit(1)).alias("n"))
    if tabs:
        (one,) = by
        zero = F.lit(0).cast("bigint")
        grid = steps_frame(devices.sparkSession, steps).select("grp").distinct()
        counts = counts.unionByName(grid.select("grp", F.explode(F.array(*[F.lit(t) for t in tabs])).alias(one),
                                                zero.alias("mask"), zero.alias("n")))
    s = steps_frame(devices.sparkSession, steps).select("grp", "step_no", "step", "ord").distinct()
    joined = counts.join(s, "grp", "inner")
    reached = depth(F.col("mask")) >= F.col("ord")
    hit = (F.expr("shiftright(mask, ord)") % 2) == 1
    return (joined.groupBy("grp", *by, "step_no", "step")
            .agg(F.sum("n").alias("assigned"),
                 F.sum(F.when(reached, F.col("n")).otherwise(F.lit(0))).alias("reached"),
                 F.sum(F.when(hit, F.col("n")).otherwise(F.lit(0))).alias("hit")))


def _rate(num: Column, den: Column) -> Column:
    return F.round(F.try_divide(num.cast("double"), den.cast("double")), 6)


def gap_devices(devices: DataFrame, gaps=None, by: str = "country_code", all_label=dims.ALL_COUNTRIES) -> DataFrame:
    """(grp, <by>, step, gap_devices): devices whose version has a known
    tracking gap at the step, per ``by`` and over all."""
    known = gaps_frame(devices.sparkSession, gaps).select("grp", "app_version", "step").distinct()
    counts = (devices.groupBy("grp", by, "app_version").agg(F.count(F.lit(1)).alias("n")).join(known, ["grp", "app_version"])
              .groupingSets([["grp", by, "step"], ["grp", "step"]], "grp", by, "step")
              .agg(F.sum("n").alias("gap_devices"), F.grouping_id().alias("gid")))
    return counts.select("grp", F.when(F.col("gid") > 0, F.lit(all_label)).otherwise(F.col(by)).alias(by), "step", "gap_devices")


def funnel_metrics(reach: DataFrame, gaps=None, groups=None, min_sample: int = dims.SMALL_SAMPLE_MIN,
                   by: str = "country_code", devices: DataFrame | None = None) -> DataFrame:
    """Step conversion, start conversion, step loss, small-sample and
    known-gap flags.

    A known gap is one of a group, a version and a step. With ``devices``
    (the devices of the reach table) a row is marked if devices of such a
    version are in it, and ``gap_devices`` counts them; a table by version
    is marked by its own versions; else every version is taken to occur.

    Small sample: in a country, if either group's first-step base is
    below ``min_sample`` (an absent group counts as 0), both are flagged.
    """
    gs = list(groups or dims.GROUPS)
    w = Window.partitionBy("grp", by).orderBy("step_no")
    prev = F.lag("reached").over(w)
    base = F.first("reached").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    country_w = Window.partitionBy(by)
    first_base = F.when(F.col("step_no") == 1, F.col("reached"))
    n_groups = F.size(F.collect_set(F.when(F.col("step_no") == 1, F.col("grp"))).over(country_w))
    min_base = F.min(first_base).over(country_w)
    small = (n_groups < F.lit(len(gs))) | (min_base < F.lit(min_sample))
    if devices is not None:
        marks, on = gap_devices(devices, gaps, by), ["grp", by, "step"]
    else:
        on = ["grp", "app_version", "step"] if by == "app_version" else ["grp", "step"]
        marks = gaps_frame(reach.sparkSession, gaps).select(*on).distinct()
    out = (reach.select("*", prev.alias("prev_reached"), base.alias("base"), small.alias("small_sample"))
           .join(marks.withColumn("is_known_gap", F.lit(True)), on, "left"))
    counted = [F.coalesce(F.col("gap_devices"), F.lit(0).cast("bigint")).alias("gap_devices")] if devices is not None else []
    return out.select(
        "grp", by, "step_no", "step", "assigned", "reached", "hit", "prev_reached", "base",
        _rate(F.col("reached"), F.col("prev_reached")).alias("step_rate"),
        _rate(F.col("reached"), F.col("base")).alias("start_rate"),
        (F.col("prev_reached") - F.col("reached")).alias("step_loss"),
        "small_sample",
        F.coalesce(F.col("is_known_gap"), F.lit(False)).alias("is_known_gap"), *counted,
    )


def country_funnel(events: DataFrame, assign_events: DataFrame, start, cutoff, steps=None,
                   platform: str | None = dims.PLATFORM) -> DataFrame:
    """R-5 end to end: assignment status -> stable devices -> masks -> reach."""
    status = X.assignment_status(assign_events, start, cutoff, platform)
    devices = device_funnel(X.stable_devices(status), step_masks(events, steps, cutoff=cutoff))
    return funnel_reach(devices, steps, tabs=COUNTRY_TABS)


def funnel_by_country(reach: DataFrame, groups=None) -> DataFrame:
    """The dashboard table: per country tab and step, A and B side by side
    (conditional sums over the small reach table, one row per step)."""
    gs = list(groups or dims.GROUPS)
    cols = []
    for g in gs:
        for c in ("assigned", "reached", "hit"):
            # a group without devices in a country counts 0
            cols.append(F.coalesce(F.sum(F.when(F.col("grp") == F.lit(g), F.col(c))), F.lit(0).cast("bigint"))
                        .alias(f"{c}_{g.lower()}"))
    return reach.groupBy("country_code", "step_no").agg(*cols)


def lesson_reach(events: DataFrame, stable: DataFrame, lessons=None, cutoff=None) -> DataFrame:
    """Devices per group and first-lesson id: stable devices with a lesson
    event before ``cutoff`` for one of their group's lessons. (device, lesson) pairs are
    made distinct first, which combines map-side, then joined to devices."""
    ls = lessons or {"A": dims.LESSONS_A, "B": dims.LESSONS_B}
    pairs = (between_times(events, None, cutoff).where(F.col("event_name") == dims.LESSON_EVENT)
             .select("user_pseudo_id", P.param("lesson_id", "int_value").alias("lesson_id"))
             .where(F.col("lesson_id").isNotNull())
             .distinct())
    allowed = F.array(*[F.lit(f"{g}:{x}") for g, xs in ls.items() for x in xs])
    return (pairs.join(stable.select("user_pseudo_id", "grp"), "user_pseudo_id", "inner")
            .where(F.array_contains(allowed, F.concat(F.col("grp"), F.lit(":"), F.col("lesson_id").cast("string"))))
            .groupBy("grp", "lesson_id").agg(F.count(F.lit(1)).alias("devices")))


def input_steps(event_of: dict[str, str]) -> list[tuple]:
    """The input metrics as a step list: sign-up, first lesson start and
    finish, the paywalls and the checkout start, of both groups. Those
    without an event of their own by definition are counted where
    ``event_of`` names their event (``dims.INPUT_SCREENS``)."""
    unknown = set(event_of) - set(dims.INPUT_SCREENS)
    if unknown:
        raise ValueError(f"unknown metrics: {sorted(unknown)}")
    rows = []
    for grp, lessons in (("A", dims.LESSONS_A), ("B", dims.LESSONS_B)):
        own = [int(x) for x in lessons]
        metrics = [("signup", dims.SIGNUP_RESULT, None, True), ("lesson_start", dims.LESSON_EVENT, own, False)]
        metrics += [(m, event_of[m], own if m == "lesson_finish" else None, False) for m in dims.INPUT_SCREENS if m in event_of]
        metrics.append(("checkout_start", dims.CHECKOUT_EVENT, None, False))
        rows += [(grp, n, *m) for n, m in enumerate(metrics, 1)]
    return rows


def input_reach(events: DataFrame, stable: DataFrame, event_of: dict[str, str], cutoff=None) -> DataFrame:
    """Reach of every input metric per group and country tab: stable
    devices that hit it before ``cutoff``, whatever else they hit."""
    steps = input_steps(event_of)
    devices = device_funnel(stable, step_masks(events, steps, cutoff=cutoff))
    reach = funnel_reach(devices, steps, tabs=COUNTRY_TABS)
    return reach.select("grp", "country_code", F.col("step").alias("metric"), "assigned", F.col("hit").alias("devices"),
                        _rate(F.col("hit"), F.col("assigned")).alias("rate"))


def country_tab(funnel: DataFrame, tab: str = dims.ALL_COUNTRIES) -> DataFrame:
    """One dashboard tab: "ALL" or one country code."""
    return funnel.where(F.col("country_code") == F.lit(tab))


def step_event_names(steps=None) -> list[str]:
    return sorted({r[3] for r in (default_steps() if steps is None else steps)})
