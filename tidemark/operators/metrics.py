"""Time-series operators over metric samples (ts, name, labels, value).

Range operators work on tumbling windows, where the samples of one series in one window are the range, or on
ranges that look back from evenly spaced moments and overlap; those are made from cells, without copies of samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import is_finite
from tidemark.operators.prefix import Running, blocked_running
from tidemark.operators.sliding import Measure, over_ranges, seconds_into_block

SERIES = ["name", "labels_key"]

# Labels that identify one run of a process and must never mark a series.
RUNTIME_LABELS = ("job_id", "task_id", "task_attempt_id", "task_attempt_num", "operator_id", "tm_id")


def label(name: str) -> Column:
    return F.try_element_at(F.col("labels"), F.lit(name))


def with_series(samples: DataFrame) -> DataFrame:
    """Add ``labels_key``: the sorted labels as text, which can be grouped and joined on."""
    entries = F.array_sort(F.map_entries("labels"))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return samples.withColumn("labels_key", text)


def select_series(samples: DataFrame, name_pattern: str, **label_patterns: str) -> DataFrame:
    """Series whose whole name, and whole label values, match the patterns."""
    chosen = F.col("name").rlike(f"^(?:{name_pattern})$")
    for key, pattern in label_patterns.items():
        chosen = chosen & F.coalesce(label(key), F.lit("")).rlike(f"^(?:{pattern})$")
    return samples.filter(chosen)


def instant_vector(samples: DataFrame, name: str) -> DataFrame:
    """The latest value of each series of a metric; non-finite values and series without a subtask are left out."""
    latest = with_series(samples.filter(F.col("name") == name)).groupBy("labels_key").agg(
        F.max("ts").alias("ts"), F.max_by("value", "ts").alias("value"), F.max_by("labels", "ts").alias("labels")
    )
    return latest.select(label("subtask_index").alias("subtask"), "ts", "value").filter(
        F.col("subtask").isNotNull() & is_finite(F.col("value"))
    )


def with_previous(samples: DataFrame, block_seconds: int = 86_400) -> DataFrame:
    """Add each sample's predecessor in its series as ``previous`` and ``previous_ts``.

    The window runs inside blocks of time; the first sample of a block takes the last one of the block
    before it, so a long history of one series is spread over tasks.
    """
    marked = with_series(samples).withColumn("_block", F.floor(F.unix_seconds("ts") / F.lit(block_seconds)))
    inside = Window.partitionBy(*SERIES, "_block").orderBy("ts")
    sample = F.struct("ts", "value")
    last = marked.groupBy(*SERIES, "_block").agg(F.max_by(sample, "ts").alias("_last"))
    edge = last.withColumn("_edge", F.lag("_last").over(Window.partitionBy(*SERIES).orderBy("_block"))).drop("_last")
    before = F.coalesce(F.lag(sample).over(inside), F.col("_edge"))
    joined = marked.join(edge, [*SERIES, "_block"], "left").withColumn("_before", before)
    return joined.withColumns({"previous": F.col("_before.value"), "previous_ts": F.col("_before.ts")}).drop(
        "_block", "_edge", "_before"
    )


def windowed(rows: DataFrame, seconds: int) -> DataFrame:
    """Each row with the start of the consecutive window that holds it."""
    start = F.floor(F.unix_seconds("ts") / F.lit(seconds)) * F.lit(seconds)
    return rows.withColumn("window_start", F.timestamp_seconds(start))


def ranged(
    rows: DataFrame, keys: list[str], measures: dict[str, Measure], seconds: int, every: int | None
) -> DataFrame:
    """The measures per key and range.

    Without ``every`` ranges are consecutive windows and named by their start.  With it there is an
    evaluation every so many seconds, named by its moment, that looks back over (at - seconds, at].
    """
    if every is not None:
        return over_ranges(rows, keys, measures, seconds, every)
    totals = [getattr(F, m.kind)(m.value).alias(name) for name, m in measures.items()]
    return windowed(rows, seconds).groupBy(*keys, "window_start").agg(*totals)


def _steps(samples: DataFrame) -> DataFrame:
    """Finite samples that have a predecessor, with the step from it; a drop counts as a restart from zero."""
    stepped = with_previous(samples.filter(is_finite(F.col("value")))).filter("previous IS NOT NULL")
    step = F.when(F.col("value") < F.col("previous"), F.col("value")).otherwise(F.col("value") - F.col("previous"))
    return stepped.withColumn("step", step)


def counter_change(samples: DataFrame, seconds: int = 60, every: int | None = None) -> DataFrame:
    """Increase and rate of each counter per range, a drop counting as a restart from zero.

    The step between two samples belongs to the range of the later one, so the increases of
    consecutive windows add up to the whole change of a series.  Nothing is extrapolated.
    """
    grouped = ranged(_steps(samples), SERIES, {"step": Measure("sum", F.col("step"))}, seconds, every)
    return grouped.withColumn("increase", F.round("step", 6)).drop("step").select(
        "*", F.round(F.col("increase") / F.lit(seconds), 6).alias("rate")
    )


def rate_by(samples: DataFrame, labels: list[str], seconds: int = 60, every: int | None = None) -> DataFrame:
    """Sum over the rates of all series of a metric, by label and range."""
    named = _steps(samples).select("name", "ts", "step", *[label(n).alias(n) for n in labels])
    summed = ranged(named, ["name", *labels], {"step": Measure("sum", F.col("step"))}, seconds, every)
    return summed.withColumn("sum_rate", F.round(F.col("step") / F.lit(seconds), 6)).drop("step")


def counters_increased(samples: DataFrame, seconds: int = 300, every: int | None = None) -> DataFrame:
    """Ranges in which a counter grew."""
    return counter_change(samples, seconds, every).filter("increase > 0").drop("rate")


def slope(samples: DataFrame, seconds: int = 120, every: int | None = None) -> DataFrame:
    """Least-squares slope of each gauge per range of two samples or more, in units per second.

    It is NULL where all samples of a range have one time.
    """
    finite = with_series(samples.filter(is_finite(F.col("value"))))
    if every is None:
        at = F.unix_micros("ts") / F.lit(1e6) - F.unix_seconds("window_start")
        sloped = windowed(finite, seconds).groupBy(*SERIES, "window_start").agg(
            F.count(F.lit(1)).alias("n"), F.regr_slope("value", at).alias("slope")
        )
        return sloped.filter("n > 1").select(*SERIES, "window_start", F.round("slope", 6).alias("slope"))
    timed = finite.withColumn("x", seconds_into_block(seconds, every)).withColumn("y", F.col("value"))
    # in the block after its own, a cell lies one block length further back
    back = F.lit(float(seconds))
    measures = {
        "n": Measure("sum", F.lit(1).cast("long")),
        "sx": Measure("sum", F.col("x"), F.col("sx") - F.col("n") * back),
        "sy": Measure("sum", F.col("y")),
        "sxx": Measure("sum", F.col("x") * F.col("x"), F.col("sxx") - 2 * back * F.col("sx") + F.col("n") * back * back),
        "sxy": Measure("sum", F.col("x") * F.col("y"), F.col("sxy") - back * F.col("sy")),
    }
    sums = over_ranges(timed, SERIES, measures, seconds, every).filter("n > 1")
    spread = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    together = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    return sums.select(*SERIES, "at", F.round(F.when(spread > 0, together / spread), 6).alias("slope"))


def max_over_time(samples: DataFrame, seconds: int = 900, every: int | None = None) -> DataFrame:
    finite = with_series(samples.filter(is_finite(F.col("value"))))
    return ranged(finite, SERIES, {"max_value": Measure("max", F.col("value"))}, seconds, every)


def aggregate_by(samples: DataFrame, labels: list[str]) -> DataFrame:
    """Sum and maximum of the samples of one instant, by label."""
    return (
        samples.filter(is_finite(F.col("value")))
        .groupBy("name", "ts", *[label(name).alias(name) for name in labels])
        .agg(F.sum("value").alias("sum_value"), F.max("value").alias("max_value"))
    )


def sum_or_zero(samples: DataFrame, alias: str = "total") -> DataFrame:
    """One number whatever matches: the sum of the samples, or zero when there are none."""
    return samples.agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias(alias))


def watermark_lag(samples: DataFrame) -> DataFrame:
    """How many seconds each subtask's watermark trails the scrape, per instant."""
    lag = (F.unix_millis("ts") - F.col("value")) / 1_000
    return samples.groupBy("ts", label("subtask_index").alias("subtask")).agg(
        F.round(F.max(lag), 3).alias("lag_seconds")
    )


def alerts_held(
    samples: DataFrame, condition: Column, hold_seconds: int, block_seconds: int = 86_400, stale_seconds: int = 300
) -> DataFrame:
    """Spans in which a condition held for every sample of a series for at least ``hold_seconds``.

    A span is the run of samples between two at which the condition is false; silence of more than
    ``stale_seconds`` also ends it.  The number of such breaks so far names the span; it is a running
    count carried over blocks of time, so a long history of one series is spread over tasks.  Samples
    may be those of a derived series with columns ts, name, labels and value.
    """
    silent = F.unix_micros("ts") - F.unix_micros("previous_ts") > stale_seconds * 1_000_000
    flagged = with_previous(samples, block_seconds).select(
        *SERIES, "ts", condition.alias("holds"), F.coalesce(silent, F.lit(False)).alias("silent")
    )
    numbered = blocked_running(
        flagged,
        SERIES,
        ["ts"],
        F.floor(F.unix_seconds("ts") / F.lit(block_seconds)),
        {"span": Running("sum", F.when(F.col("holds") & ~F.col("silent"), 0).otherwise(1).cast("long"))},
    )
    spans = numbered.filter("holds").groupBy(*SERIES, "span").agg(
        F.min("ts").alias("active_from"),
        F.max("ts").alias("active_to"),
        F.count(F.lit(1)).alias("samples"),
    )
    held = F.unix_seconds("active_to") - F.unix_seconds("active_from")
    return spans.filter(held >= hold_seconds).select(
        *SERIES,
        "active_from",
        (F.col("active_from") + F.make_dt_interval(secs=F.lit(hold_seconds))).alias("fires_at"),
        "active_to",
        "samples",
    )


def target_health(samples: DataFrame, expected: tuple[str, ...], seconds: int = 60) -> DataFrame:
    """Per window, how many targets were up at their last scrape, and the expected ones that were not."""
    latest = (
        samples.withColumn(
            "window_start", F.timestamp_seconds(F.floor(F.unix_seconds("ts") / seconds) * F.lit(seconds))
        )
        .groupBy("window_start", label("job").alias("job"))
        .agg(F.max_by("value", "ts").alias("value"))
    )
    # Expected targets are a fixed list, so the set of healthy ones is bounded by it.
    healthy = F.collect_set(F.when((F.col("value") == 1) & F.col("job").isin(*expected), F.col("job")))
    return latest.groupBy("window_start").agg(
        F.count_if(F.col("value") == 1).alias("targets_up"),
        F.array_join(F.array_except(F.array(*[F.lit(t) for t in expected]), healthy), ",").alias("missing"),
    )


def forbidden_labels(samples: DataFrame, forbidden: tuple[str, ...] = RUNTIME_LABELS) -> DataFrame:
    """Per metric, the samples and how many of them carry a label that must not exist."""
    leaky = F.arrays_overlap(F.map_keys("labels"), F.array(*[F.lit(name) for name in forbidden]))
    return samples.groupBy("name").agg(
        F.count(F.lit(1)).alias("samples"), F.count_if(leaky).alias("leaky_samples")
    )
