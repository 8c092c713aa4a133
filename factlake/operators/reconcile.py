"""Reconciliation of derived mappings with an upstream table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def active_ids(records: DataFrame, aliases: str = "aliases") -> DataFrame:
    """Aliases of active records, each once."""
    return records.filter("status = 'active'").select(F.explode(aliases).alias("alias")).distinct()


def added(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    return now.select(key).distinct().join(before.select(key).distinct(), key, "left_anti")


def scan_ids(active: DataFrame, before: DataFrame, files: DataFrame, path_id: Column, truncated: bool) -> DataFrame:
    """Ids to look at again: newly active ones and active ones whose file changed, under its old or new name; all active ones
    if the list of files was cut off."""
    if truncated:
        return active.select("alias").distinct()
    names = files.select(F.explode(F.array("filename", "previous_filename")).alias("path")).filter("path is not null")
    touched = names.select(path_id.alias("alias")).filter("alias is not null").distinct().join(active, "alias", "left_semi")
    return added(active, before, "alias").union(touched).distinct()


def top_n(rows: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """The first n distinct values of each key, ascending: Spark limits each group before its shuffle."""
    w = Window.partitionBy(key).orderBy(value)
    return rows.select(key, value).distinct().withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def selection_counts(rows: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """How many of each key's values are selected, and how many are known."""
    known = rows.groupBy(key).agg(F.countDistinct(value).alias("total_known_count"))
    return known.withColumn("selected_count", F.least("total_known_count", F.lit(n).cast("long")))


def removals(previous: DataFrame, selected: DataFrame, listed: DataFrame, key: str, value: str, present: DataFrame) -> DataFrame:
    """Pairs (key, value) of a previous selection that a new one lacks, with the reason: the key's file is gone, the value is
    still listed but beyond the limit, or it was removed. Only keys looked at count (``present`` has key, exists)."""
    gone = previous.select(key, value).distinct().join(selected.select(key, value), [key, value], "left_anti")
    known = listed.select(key, value).distinct().withColumn("listed", F.lit(True))
    reason = F.when(~F.col("exists"), "source_file_absent").when(F.col("listed"), "selection_limit").otherwise("source_reference_removed")
    return gone.join(present, key).join(known, [key, value], "left").select(key, value, reason.alias("reason"))


def regrouped(pairs: DataFrame, removed: DataFrame, key: str, value: str) -> DataFrame:
    """Values with the keys that they keep, sorted; values that keep none have an empty list and the status of their reason."""
    state = F.max(F.when(F.col("reason") == "selection_limit", 2).when(F.col("reason").isNotNull(), 1))
    both = pairs.join(removed, [key, value], "left").groupBy(value)
    out = both.agg(F.array_sort(F.collect_set(F.when(F.col("reason").isNull(), F.col(key)))).alias("kept"), state.alias("_s"))
    status = F.when(F.size("kept") > 0, "active").when(F.col("_s") == 2, "selection_removed").otherwise("source_deleted")
    return out.select(value, "kept", status.alias("status"))


def single_value(column: str) -> Column:
    """The only value of a group, where null counts as a value; null if there are more."""
    n = F.countDistinct(column) + F.max(F.col(column).isNull().cast("int"))
    return F.when(n == 1, F.max(column))


def baseline(versions: DataFrame, key: str, at: str, cutoff: Column) -> DataFrame:
    """Each key's last version at or before the cutoff."""
    rest = [c for c in versions.columns if c != key]
    last = versions.filter(F.col(at) <= cutoff).groupBy(key).agg(F.max_by(F.struct(*rest), at).alias("v"))
    return last.select(key, *[F.col(f"v.`{c}`").alias(c) for c in rest])


def material_change(versions: DataFrame, key: str, at: str, start: Column, end: Column, final: DataFrame, differs: Column) -> DataFrame:
    """For each key of ``final`` the newest version in [start, end] that differs from it (a condition on versions ``v`` and
    final rows ``f``), or nothing."""
    v, f = versions.filter(F.col(at).between(start, end)).alias("v"), final.alias("f")
    found = v.join(f, F.col(f"v.{key}") == F.col(f"f.{key}")).filter(differs)
    return found.groupBy(F.col(f"f.{key}").alias(key)).agg(F.max(f"v.{at}").alias("changed_at"))


def admission(candidates: DataFrame, proof: DataFrame, key: str, start: Column) -> DataFrame:
    """admit, drop or pending of bootstrap candidates (key, has_watermark, stored, published_at, status, baseline: absent,
    same or changed): known ones, those published in the window and proven changes are admitted; a key that the baseline lacks
    is proven only if it is rejected now, and without a proof it stays pending."""
    known = F.col("has_watermark") | F.col("stored") | F.coalesce(F.col("published_at") >= start, F.lit(False))
    proven = F.when(F.col("baseline") == "absent", F.col("status") == "rejected").otherwise(F.col("changed_at").isNotNull())
    verdict = F.when(known, "admit").when(F.col("baseline") == "same", "drop").when(proven, "admit").otherwise("pending")
    return candidates.join(proof, key, "left").select(key, verdict.alias("verdict"))


def touched_but_unwanted(previous: DataFrame, affected: DataFrame, desired: DataFrame) -> DataFrame:
    """Stored derived rows (record_id, provenance_ids) of affected sources that are wanted no more."""
    touched = previous.select("record_id", F.explode("provenance_ids").alias("source_record_id")).join(affected, "source_record_id", "left_semi")
    return touched.select("record_id").distinct().join(desired.select("record_id"), "record_id", "left_anti")


def changed_templates(stored: DataFrame, inventory: DataFrame) -> DataFrame:
    """Paths of inventory (path, sha) that are new, differ from what is stored (path, sha, dependencies), or depend on a file
    that does."""
    same = inventory.join(stored.select("path", "sha"), ["path", "sha"])
    deps = stored.select("path", F.explode("dependencies").alias("dep")).select("path", "dep.path", "dep.sha").toDF("path", "dep_path", "dep_sha")
    now = inventory.select(F.col("path").alias("dep_path"), F.col("sha").alias("now_sha"))
    stale = deps.join(now, "dep_path", "left").filter(~F.col("dep_sha").eqNullSafe(F.col("now_sha"))).select("path").distinct()
    fresh = same.select("path").join(stale, "path", "left_anti")
    return inventory.select("path").join(fresh, "path", "left_anti")


def resolved_dependencies(templates: DataFrame, inventory: DataFrame, budget: int) -> DataFrame:
    """Dependencies of templates (path, dependencies array of paths) with a reason where one is missing, no regular file, or
    beyond the byte budget of its template, in order."""
    each = templates.select("path", F.posexplode("dependencies").alias("position", "dep_path"))
    files = inventory.select(F.col("path").alias("dep_path"), "sha", "size", "mode")
    w = Window.partitionBy("path").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    joined = each.join(files, "dep_path", "left").withColumn("upto", F.sum("size").over(w))
    reason = F.when(F.col("sha").isNull(), "missing").when(~F.col("mode").isin("100644", "100755"), "not a file").when(F.col("upto") > budget, "over budget")
    return joined.select("path", "position", "dep_path", "sha", "upto", reason.alias("reason"))


def late_deletions(changed: DataFrame, final: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """Changed keys that the final version lacks and the state has."""
    return changed.select(key).distinct().join(final.select(key), key, "left_anti").join(previous.select(key), key, "left_semi")


def carried_over(entries: DataFrame, eligible: DataFrame) -> DataFrame:
    """Observations whose key is still eligible under the same URL."""
    return entries.join(eligible.select("key", "url_sha256"), ["key", "url_sha256"], "left_semi")


def maintained_aliases(state: DataFrame, changed: DataFrame, deleted: DataFrame) -> DataFrame:
    """Alias state (record_id, aliases) after a change set: deleted and changed rows go, changed active ones come back."""
    kept = state.join(deleted.select("record_id").union(changed.select("record_id")).distinct(), "record_id", "left_anti")
    now = changed.filter("status = 'active'").groupBy("record_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("aliases")))).alias("aliases"))
    return kept.unionByName(now)


def excluded_references(rows: DataFrame) -> DataFrame:
    """Distinct (record_id, reference index, URL digest, reason) of references that are left out."""
    return rows.select("record_id", "reference_index", F.sha2(F.coalesce("url", F.lit("")), 256).alias("url_sha256"), "reason").distinct()


def without(mapping: Column, keys: Column) -> Column:
    """A map without some keys."""
    return F.map_filter(mapping, lambda k, _: ~F.array_contains(keys, k))


def with_entries(mapping: Column, update: Column) -> Column:
    """A map with the entries of another, which win."""
    return F.map_concat(F.map_filter(mapping, lambda k, _: ~F.array_contains(F.map_keys(update), k)), update)
