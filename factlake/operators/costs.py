"""Cost roll-ups, projections and history replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows of a chain that a window takes at once.
BLOCK_ROWS = 1_000_000


def roll_up(charges: DataFrame, sets: list[list[str]], measures: list[Column]) -> DataFrame:
    """Several groupings in one pass; ``grouping`` tells them apart."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    return charges.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(F.grouping_id().alias("grouping"), *measures)


def month_projection(charges: DataFrame, month: Column) -> DataFrame:
    """One row: initialisation plus the steady rate of the days observed, over the month (charges: day, phase, bytes)."""
    own = charges.filter(F.trunc("day", "month") == month)
    steady = F.col("phase") == "steady"
    sums = own.agg(
        F.coalesce(F.sum(F.when(~steady, F.col("bytes"))), F.lit(0)).alias("initial_bytes"),
        F.coalesce(F.sum(F.when(steady, F.col("bytes"))), F.lit(0)).alias("steady_bytes"),
        F.countDistinct(F.when(steady, F.col("day"))).alias("observed_days"),
    )
    days = F.dayofmonth(F.last_day(month))
    rate = F.when(F.col("observed_days") > 0, F.col("steady_bytes") / F.col("observed_days")).otherwise(0.0)
    return sums.withColumn("projected_bytes", F.col("initial_bytes") + rate * days)


def minutes(seconds: Column) -> Column:
    """Billed minutes: begun ones count, one at least."""
    return F.greatest(F.lit(1), F.ceil(seconds / 60)).cast("long")


def settled_minutes(reservations: DataFrame, actual: DataFrame) -> DataFrame:
    """Minutes of each job: the actual ones where it has ended, else what is reserved."""
    done = actual.select("job_id", minutes(F.col("seconds")).alias("actual"))
    return reservations.join(done, "job_id", "left").select("job_id", F.coalesce("actual", "reserved_minutes").alias("minutes"))


def reserved_by_day(reservations: DataFrame, limit: int) -> DataFrame:
    out = reservations.groupBy("day").agg(F.sum(F.coalesce("charged_bytes", "reserved_bytes")).alias("bytes"))
    return out.withColumn("exceeded", F.col("bytes") > limit)


def reference_accounting(observed: DataFrame, accounted: DataFrame, intents: DataFrame) -> DataFrame:
    """Each branch's head: accounted, recovered (an intent for it is known) or unaccounted."""
    a = accounted.select("branch", F.col("sha").alias("known"))
    i = intents.select("branch", F.col("sha").alias("meant")).distinct()
    both = observed.join(a, "branch", "left").join(i, (observed["branch"] == i["branch"]) & (observed["sha"] == i["meant"]), "left")
    status = F.when(F.col("sha").eqNullSafe(F.col("known")), "accounted").when(F.col("meant").isNotNull(), "recovered").otherwise("unaccounted")
    return both.select(observed["branch"], "sha", status.alias("status"))


def object_diff(candidate: DataFrame, baselines: DataFrame, key: str, kind: str, size: str) -> DataFrame:
    """Number and bytes, by type, of the candidate's objects that no baseline has."""
    new = candidate.select(key, kind, size).distinct().join(baselines.select(key).distinct(), key, "left_anti")
    return new.groupBy(kind).agg(F.count(F.lit(1)).alias("n_objects"), F.sum(size).alias("bytes"))


def unknown_parents(candidates: DataFrame, tips: DataFrame) -> DataFrame:
    """Commits (sha, parents) that are no tip and have a parent that is none."""
    each = candidates.join(tips.select("sha"), "sha", "left_anti").select("sha", F.explode("parents").alias("parent"))
    return each.join(tips.select(F.col("sha").alias("parent")), "parent", "left_anti").select("sha", "parent")


def chain_order(commits: DataFrame, chain: str, pos: str, at: str, tie: str) -> DataFrame:
    """Commits with the key by which all chains replay: repeatedly taking the least head of the chains is sorting by the
    greatest (time, chain, id) of a chain so far, then by place, a number. A long chain is taken in blocks of places, some
    ``BLOCK_ROWS`` rows each if places lie evenly: a window within each, over which goes the greatest key of the blocks before."""
    so_far = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    ends = commits.groupBy(chain).agg(F.min(pos).alias("_lo"), (F.max(pos) - F.min(pos) + 1).alias("_span"), F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("_blocks"))
    block = F.floor((F.col(pos) - F.col("_lo")) / F.col("_span") * F.col("_blocks"))
    dealt = commits.join(ends.withColumnRenamed(chain, "_chain"), F.col(chain).eqNullSafe(F.col("_chain"))).withColumn("_block", F.coalesce(block, F.lit(-1)))
    own = F.max(F.struct(at, chain, tie)).over(so_far(Window.partitionBy(chain, "_block").orderBy(pos)))
    greatest = dealt.groupBy("_chain", "_block").agg(F.max(F.struct(at, chain, tie)).alias("_m"))
    before = Window.partitionBy("_chain").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block
    greatest = greatest.select(F.col("_chain").alias("_of"), F.col("_block").alias("_at"), F.max("_m").over(before).alias("_before"))
    both = dealt.withColumn("_own", own).join(greatest, F.col("_chain").eqNullSafe(F.col("_of")) & (F.col("_block") == F.col("_at")))
    return both.select(*[commits[c] for c in commits.columns], F.greatest("_own", "_before").alias("replay_key"))


def cumulative(rows: DataFrame, part: list[str], order: list[Column], size: str, limit: int) -> DataFrame:
    """Running totals of each part, and whether the limit is passed."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("upto", F.sum(size).over(w)).withColumn("exceeded", F.col("upto") > limit)


def tips_after(steps: DataFrame, chains: list[str], order: str, chain: str, tip: str) -> DataFrame:
    """After each step of a replay, the last tip of each chain: a list of commits, small at any data size."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return steps.select("*", *[F.last(F.when(F.col(chain) == c, F.col(tip)), ignorenulls=True).over(w).alias(f"tip_{c}") for c in chains])


def phase(at: Column, marker: Column) -> Column:
    return F.when(at > marker, "steady").otherwise("initialization")
