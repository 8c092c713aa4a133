"""What a stream keeps between its batches, as files: a table with one row a key, of which a batch rewrites only what it touches, and
the units of an upstream version that are done. Data is written first, under the batch's name, and what names it last; a batch that is
run again therefore finds what the one before it has left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import paths

BUCKET = "state_bucket"


class Buckets:
    """A keyed table in ``n`` buckets of the key's hash. ``rows/<batch>`` holds the buckets that a batch has rewritten,
    ``manifest/<batch>`` says for each bucket which batch has it; the driver holds that list of at most ``n`` rows. ``n`` is fixed when
    the table begins; choose it so that a bucket fits a task."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, n: int = 64) -> None:
        self.spark, self.root, self.schema, self.key, self.n = spark, root, schema, key, n

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.n)).cast("int")

    def batches(self) -> list[int]:
        """Batches that have a whole manifest."""
        found = [int(x) for x in paths.names(self.spark, f"{self.root}/manifest") if x.isdigit()]
        return sorted(b for b in found if paths.exists(self.spark, f"{self.root}/manifest/{b}/_SUCCESS"))

    def manifest(self, number: int | None) -> dict[int, int]:
        """The batch that holds each bucket, as of a batch; empty before the first."""
        if number is None:
            return {}
        rows = self.spark.read.schema("bucket int, batch long, n int").parquet(f"{self.root}/manifest/{number}").collect()
        if any(r.n != self.n for r in rows):
            raise ValueError(f"the table at {self.root} has {rows[0].n} buckets, not {self.n}")
        return {r.bucket: r.batch for r in rows if r.bucket is not None}

    def _rows(self, held: dict[int, int]) -> DataFrame:
        if not held:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/rows/{batch}/{BUCKET}={bucket}" for bucket, batch in held.items()])

    def before(self, number: int) -> int | None:
        """The last batch before one."""
        return max((b for b in self.batches() if b < number), default=None)

    def read(self, number: int | None) -> DataFrame:
        """The table after a batch, of which only those that touched it have a manifest; empty before the first (None)."""
        return self._rows(self.manifest(None if number is None else self.before(number + 1)))

    def fold(self, batch: DataFrame, number: int, folded: Callable[[DataFrame], DataFrame], joined: Callable[[DataFrame, DataFrame], DataFrame] = DataFrame.unionByName) -> None:
        """Replaces the buckets that ``batch`` has keys of by ``folded`` of what ``joined`` makes of the rows there and the batch.
        Buckets that it has no key of are neither read nor written; a batch without rows leaves all as it is."""
        touched = {r[0] for r in batch.select(self.bucket()).distinct().collect()}
        if not touched:
            return
        old = self.before(number)
        held = self.manifest(old)
        rows = folded(joined(self._rows({k: b for k, b in held.items() if k in touched}), batch))
        rows.select(*self.schema.names).withColumn(BUCKET, self.bucket()).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.root}/rows/{number}")
        written = [int(x.partition("=")[2]) for x in paths.names(self.spark, f"{self.root}/rows/{number}") if x.startswith(f"{BUCKET}=")]
        now = {k: b for k, b in held.items() if k not in touched} | dict.fromkeys(written, number)
        listed = [(k, b, self.n) for k, b in sorted(now.items())] or [(None, None, self.n)]
        self.spark.createDataFrame(listed, "bucket int, batch long, n int").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/{number}")
        self._forget(old)

    def _forget(self, kept: int | None) -> None:
        """Deletes what the batch ``kept`` has replaced: the stream runs no batch before the one after it again."""
        older = self.before(kept) if kept is not None else None
        if older is None:
            return
        current = self.manifest(kept)
        for bucket, batch in self.manifest(older).items():
            if current.get(bucket) != batch:
                paths.remove(self.spark, f"{self.root}/rows/{batch}/{BUCKET}={bucket}")
        paths.remove(self.spark, f"{self.root}/manifest/{older}")


class Units:
    """Progress over the units of one upstream version. ``runs/<run>/pin`` names the version, ``runs/<run>/done/<batch>`` the units of
    a batch, ``runs/<run>/closed`` the watermark; each is written as a whole. A run that is not closed is taken up again with its own
    version, whatever the upstream has by then."""

    DONE = "unit string, content_sha256 string"

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def _has(self, path: str) -> bool:
        return paths.exists(self.spark, f"{path}/_SUCCESS")

    def _runs(self) -> list[int]:
        return sorted(int(x) for x in paths.names(self.spark, f"{self.root}/runs") if self._has(f"{self.root}/runs/{x}/pin"))

    def _write(self, path: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(path)

    @property
    def run(self) -> str:
        return f"{self.root}/runs/{self._runs()[-1]}"

    def begin(self, latest: str) -> str:
        """The version to read: that of the run that isn't closed, or else ``latest``, to which a new run is pinned."""
        runs = self._runs()
        if runs and not self._has(f"{self.run}/closed"):
            return self.spark.read.schema("version string").parquet(f"{self.run}/pin").first().version
        self._write(f"{self.root}/runs/{runs[-1] + 1 if runs else 0}/pin", self.spark.createDataFrame([(latest,)], "version string").coalesce(1))
        return latest

    def done(self) -> DataFrame:
        """Units that this run has finished, with the digest of what they had."""
        whole = [f"{self.run}/done/{x}" for x in paths.names(self.spark, f"{self.run}/done") if self._has(f"{self.run}/done/{x}")]
        return self.spark.read.schema(self.DONE).parquet(*whole) if whole else self.spark.createDataFrame([], self.DONE)

    def pending(self, units: DataFrame) -> DataFrame:
        """Units (unit, content_sha256) that are not done, or have changed since."""
        return units.join(self.done(), ["unit", "content_sha256"], "left_anti")

    def once(self, batch: str, units: DataFrame, write: Callable[[], None]) -> bool:
        """Writes a batch's data, then its units; a batch whose units are there is skipped. ``write`` is to overwrite what a run that
        broke between the two has left."""
        path = f"{self.run}/done/{batch}"
        if self._has(path):
            return False
        write()
        self._write(path, units.select("unit", "content_sha256"))
        return True

    def watermark(self) -> str | None:
        """The watermark of the last closed run."""
        closed = [r for r in self._runs() if self._has(f"{self.root}/runs/{r}/closed")]
        return self.spark.read.schema("watermark string").parquet(f"{self.root}/runs/{closed[-1]}/closed").first().watermark if closed else None

    def close(self, units: DataFrame, watermark: str) -> bool:
        """Moves the watermark and ends the run, if all of the version's units are done; else nothing changes."""
        if not self.pending(units).isEmpty():
            return False
        self._write(f"{self.run}/closed", self.spark.createDataFrame([(watermark,)], "watermark string").coalesce(1))
        return True
