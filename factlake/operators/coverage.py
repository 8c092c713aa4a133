"""Coverage gates, health and observation windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

INTERVAL_SECONDS, GRACE_SECONDS, NEEDED_SECONDS = 900, 60, 86400


def coverage(required: DataFrame, sources: DataFrame) -> DataFrame:
    """One row: whether each required source is ok, has a watermark and no continuation, gaps or errors; which are not."""
    ok = (F.col("status") == "ok") & F.col("completed_watermark").isNotNull() & F.col("continuation").isNull() & (F.coalesce(F.size("coverage_gaps"), F.lit(0)) == 0) & (F.coalesce(F.size("errors"), F.lit(0)) == 0)
    judged = required.join(sources, "source_id", "left").select("source_id", F.coalesce(ok, F.lit(False)).alias("ok"))
    return judged.agg(F.coalesce(F.bool_and("ok"), F.lit(False)).alias("complete"), F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col("source_id")))).alias("incomplete"))


def thresholds(metrics: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Advisory observations of a one-row frame: metric, observed, threshold, exceeded. Nothing is dropped for exceeding."""
    pairs = ", ".join(f"'{m}', cast({m} as double), cast({t} as double)" for m, t in limits.items())
    return metrics.selectExpr(f"stack({len(limits)}, {pairs}) as (metric, observed, threshold)").withColumn("exceeded", F.col("observed") > F.col("threshold"))


def measured(rows: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``rows`` and what is measured of them, as aggregates, while they are written: no second scan. Write the frame as it is,
    without a shuffle after it, so that a task that is run again is counted once; the metrics are there after the write."""
    seen = Observation()
    return rows.observe(seen, *[c.alias(name) for name, c in metrics.items()]), seen


def health_metrics(source: str, size: str, names: Sequence[str]) -> dict[str, Column]:
    """Aggregates for ``measured``: rows and bytes in all, of each named source and of the rest; names are a short list, values whose
    sum is null count as 0."""
    sets = {"": F.lit(True)} | {f":{n}": F.coalesce(F.col(source) == n, F.lit(False)) for n in names} | {":": ~F.coalesce(F.col(source).isin(list(names)), F.lit(False))}
    found = {f"n_rows{k}": F.count_if(c) for k, c in sets.items()}
    return found | {f"bytes{k}": F.coalesce(F.sum(F.when(c, F.col(size))), F.lit(0)).cast("long") for k, c in sets.items()}


def measured_health(spark: SparkSession, seen: Observation, source: str, names: Sequence[str]) -> DataFrame:
    """What ``health_metrics`` measured, as rows like those of ``source_health``: a row for each named source that has rows, and one
    with a null name for the rest, if there are any."""
    got = seen.get
    rows = [(n, got[f"n_rows:{n or ''}"], got[f"bytes:{n or ''}"]) for n in [*names, None]]
    return spark.createDataFrame([r for r in rows if r[1]], f"{source} string, n_rows long, bytes long")


def measured_thresholds(spark: SparkSession, seen: Observation, limits: dict[str, float]) -> DataFrame:
    """``thresholds`` of what was measured; a metric that was null has no observation and does not exceed."""
    got = seen.get
    row = spark.createDataFrame([tuple(None if got[m] is None else float(got[m]) for m in limits)], ", ".join(f"`{m}` double" for m in limits))
    return thresholds(row, limits).withColumn("exceeded", F.coalesce("exceeded", F.lit(False)))


def source_health(rows: DataFrame, source: str, size: str) -> DataFrame:
    return rows.groupBy(source).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(size).alias("bytes"))


def problems(reasons: dict[str, Column], rows: DataFrame) -> DataFrame:
    """Each reason that holds for any row, with how many."""
    each = rows.select(F.explode(F.filter(F.array(*[F.when(c, name) for name, c in reasons.items()]), lambda x: x.isNotNull())).alias("reason"))
    return each.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


def run_in_window(start: Column, end: Column) -> Column:
    """Whether a run's times are in order and its creation lies in the window."""
    ordered = (F.col("created_at") <= F.col("run_started_at")) & (F.col("run_started_at") <= F.col("updated_at")) & (F.col("updated_at") <= F.col("sampled_at"))
    return F.coalesce(ordered & F.col("created_at").between(start, end), F.lit(False))


def listing_complete(runs: DataFrame, declared_total: int, start: Column, end: Column) -> DataFrame:
    """One row: whether a listing has unique ids, all in the window, and as many as declared."""
    return runs.agg(((F.count(F.lit(1)) == F.countDistinct("id")) & (F.count(F.lit(1)) == declared_total) & F.coalesce(F.bool_and(F.col("created_at").between(start, end)), F.lit(True))).alias("complete"))


def window_successes(runs: DataFrame) -> DataFrame:
    """Of each repository: whether a manual and a scheduled run have succeeded, failed and pending runs."""
    done = (F.col("status") == "completed") & (F.col("conclusion") == "success")
    one = lambda event: F.coalesce(F.bool_or(done & (F.col("event") == event)), F.lit(False))
    return runs.groupBy("repository").agg(
        one("workflow_dispatch").alias("manual"),
        one("schedule").alias("scheduled"),
        F.array_sort(F.collect_list(F.when((F.col("status") == "completed") & (F.col("conclusion") != "success"), F.col("id")))).alias("failed"),
        F.array_sort(F.collect_list(F.when(F.col("status") != "completed", F.col("id")))).alias("pending"),
    )


def qualification(samples: DataFrame, key: str, at: str, bad: Column, longest_gap: float, needed: float, ties: Sequence[str] = ()) -> DataFrame:
    """Observation windows of each key: seconds without a break, and whether they suffice. A gap that is negative or too long,
    or a bad sample, ends the window for good; what had been gathered is reported apart. Samples of one time are ordered by ``ties``, then bad ones last."""
    w = Window.partitionBy(key).orderBy(at, *ties, bad)
    seen = samples.withColumns({"_gap": (F.col(at).cast("double") - F.lag(F.col(at).cast("double")).over(w)), "_first": F.row_number().over(w) == 1})
    broken = bad | F.coalesce((F.col("_gap") < 0) | (F.col("_gap") > longest_gap), F.lit(False))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    seen = seen.withColumn("_broken", F.max(broken).over(upto))
    good = F.coalesce(F.sum(F.when(~F.col("_broken"), F.col("_gap"))), F.lit(0.0))
    out = seen.groupBy(key).agg(good.alias("seconds"), F.bool_or("_broken").alias("invalid"), F.bool_or(F.col("_first") & bad).alias("rejected"), F.count(F.lit(1)).alias("n_samples"))
    status = F.when(F.col("rejected"), "start_rejected").when(F.col("invalid"), "invalid").when(F.col("seconds") >= needed, "review_required").otherwise("collecting")
    return out.select(key, status.alias("status"), F.when(F.col("invalid"), 0.0).otherwise(F.col("seconds")).alias("qualified_seconds"), F.when(F.col("invalid"), F.col("seconds")).otherwise(0.0).alias("seconds_before_break"), "n_samples")


def availability(entries: DataFrame, eligible: int, unsupported: int, now: Column) -> DataFrame:
    """One row of availability counts and a label."""
    out = entries.agg(F.count(F.lit(1)).alias("retained"), F.count_if(F.col("next_check_at") > now).alias("fresh"), F.count_if(F.col("next_check_at") <= now).alias("stale"))
    label = F.when(F.lit(eligible) == 0, "none").when(F.col("fresh") >= eligible, "complete").otherwise("partial")
    return out.select(F.lit(eligible).alias("eligible"), F.lit(unsupported).alias("unsupported"), "retained", "fresh", (F.lit(eligible) - F.col("fresh")).alias("due"), label.alias("coverage"))
