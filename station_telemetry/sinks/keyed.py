"""A table with one live row per key, on plain Parquet.

    <root>/buckets=<n>                          how many buckets the keys are dealt to by hash,
    <root>/buckets=ranges                       or that neighbouring keys share one
    <root>/generations/                         checkpoints that have written here
    <root>/changes/position=<p>/                rows of one batch, written as they came
    <root>/snapshot/through=<p>/bucket=<b>/     live rows of a bucket, all changes up to p applied

An upsert costs as much as the batch, not as the table. A retried batch overwrites its own
folder. Compaction rewrites the buckets that have changes, next to the old ones, and leaves the
others as they are; a snapshot counts once its `_SUCCESS` marker exists. Where new keys are
neighbours, as numbers of a station are, ranges keep compaction as small as what has changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from station_telemetry import files
from station_telemetry.operators.state import latest
from station_telemetry.sinks import generations

BUCKETS = 32
# Rows of a task that sorts: some 120 MB of documents. Twice as many changes still count as few.
TASK_ROWS = 1 << 18


class KeyedTable:
    """`columns` must contain the key and comparable `order` columns, the order within a batch.

    Rows of a later batch come after those of earlier ones; with `by_order`, only the order columns
    count, and the batch where they are equal. `range_of` gives the range of a key as text that can
    name a folder, never null; without it keys are dealt to `buckets` by hash. Either counts when the
    table is new; an existing table keeps its way.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        columns: T.StructType,
        key: str,
        order: str | tuple[str, ...],
        buckets: int = BUCKETS,
        by_order: bool = False,
        range_of: Callable[[Column], Column] | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.columns = columns
        self.key = key
        self.order = (order,) if isinstance(order, str) else order
        self.by_order = by_order
        self.range_of = range_of
        self._wanted_buckets = str(buckets) if range_of is None else "ranges"

    position = staticmethod(generations.position)

    def place(self, batch: DataFrame, batch_id: int) -> int:
        """Position of a micro-batch: after all batches of checkpoints that wrote here before."""
        return generations.position_of(batch, batch_id, f"{self.root}/generations")

    def _buckets(self) -> str:
        found = [n for n in files.child_names(self.spark, self.root) if n.startswith("buckets=")]
        if not found:
            files.make_folder(self.spark, f"{self.root}/buckets={self._wanted_buckets}")
            return self._wanted_buckets
        return found[0].removeprefix("buckets=")

    def _bucket(self, key: Column) -> Column:
        buckets = self._buckets()
        if buckets != "ranges":
            return F.pmod(F.hash(key), F.lit(int(buckets))).cast("string")
        if self.range_of is None:
            raise ValueError(f"{self.root} keeps ranges of keys: open it with range_of")
        return self.range_of(key)

    def upsert(self, rows: DataFrame, position: int) -> None:
        """Adds one batch; each row replaces the live row of its key whole."""
        (
            rows.select(*self.columns.names)
            .write.mode("overwrite")
            .parquet(f"{self.root}/changes/position={position}")
        )

    def _names(self, folder: str, prefix: str) -> list[str]:
        names = files.child_names(self.spark, f"{self.root}/{folder}")
        return [n.removeprefix(prefix) for n in names if n.startswith(prefix)]

    def _numbers(self, folder: str, prefix: str) -> list[int]:
        return [int(n) for n in self._names(folder, prefix)]

    def _finished(self, folder: str, prefix: str) -> list[int]:
        """Positions in a folder whose write has ended, in order."""
        done = lambda p: files.exists(self.spark, f"{self.root}/{folder}/{prefix}{p}/_SUCCESS")
        return [p for p in sorted(self._numbers(folder, prefix)) if done(p)]

    def _extent(self) -> tuple[int, int]:
        """(position of the newest snapshot, position of the last change), -1 where there is none."""
        snapshots, changes = self._finished("snapshot", "through="), self._finished("changes", "position=")
        return max(snapshots, default=-1), max(changes, default=-1)

    def _newest_buckets(self) -> dict[str, int]:
        """For each bucket the newest snapshot that holds it."""
        newest: dict[str, int] = {}
        for through in self._finished("snapshot", "through="):
            for bucket in self._names(f"snapshot/through={through}", "bucket="):
                newest[bucket] = through
        return newest

    def _log(self, after: int, upto: int) -> DataFrame:
        """The changes in a range of positions.

        Only those folders are opened, so Spark plans with their size, not the whole log's.
        """
        log = f"{self.root}/changes"
        columns = T.StructType([*self.columns.fields, T.StructField("position", T.LongType())])
        found = [p for p in self._finished("changes", "position=") if after < p <= upto]
        if not found:
            return self.spark.createDataFrame([], columns)
        paths = [f"{log}/position={p}" for p in found]
        return self.spark.read.schema(columns).option("basePath", log).parquet(*paths)

    def _tasks(self, log: DataFrame, settled: DataFrame) -> int:
        """Over how many tasks to spread both; 1 for few changes, which Spark spreads by itself.

        The counts come from the footers of the files.
        """
        changed = log.count()
        if changed <= 2 * TASK_ROWS:
            return 1
        return -(-max(changed, settled.count()) // TASK_ROWS)

    def _changes(self, log: DataFrame, tasks: int = 1) -> DataFrame:
        """The last change of each key.

        A file may hold more rows than a task can sort, and a key more than a task should get. So
        many rows are spread by key and time first, and each part sends its last row of a key on.
        """
        arrived = (*self.order, "position") if self.by_order else ("position", *self.order)
        if tasks > 1:
            part = F.pmod(F.xxhash64(*arrived), F.lit(tasks))
            parts = log.withColumn("_part", part).repartition(tasks, self.key, "_part")
            log = latest(parts, (self.key, "_part"), arrived).repartition(tasks, self.key)
        return latest(log, self.key, arrived).select(*self.columns.names)

    def _settled(self, buckets: dict[str, int]) -> DataFrame:
        if not buckets:
            return self.spark.createDataFrame([], self.columns)
        root = f"{self.root}/snapshot"
        paths = [f"{root}/through={through}/bucket={bucket}" for bucket, through in sorted(buckets.items())]
        return self.spark.read.schema(self.columns).parquet(*paths)

    def current(self) -> DataFrame:
        """The live rows.

        The snapshot keeps the rows that later changes do not replace. When these are few,
        Spark broadcasts their keys, from the size of their files, and the snapshot is not
        shuffled; otherwise both are shuffled by key.
        """
        through, upto = self._extent()
        settled = self._settled(self._newest_buckets())
        if upto <= through:
            return settled
        log = self._log(through, upto)
        tasks = self._tasks(log, settled)
        return self._with(settled, self._changes(log, tasks), tasks)

    def _with(self, settled: DataFrame, replaced: DataFrame, tasks: int = 1) -> DataFrame:
        if tasks > 1:
            settled = settled.repartition(tasks, self.key)
        keys = replaced.select(self.key)
        if self.by_order:
            # A settled row may be newer than the change. On a tie both are the same message.
            both = settled.join(keys, self.key, "left_semi").unionByName(replaced)
            replaced = latest(both.repartition(tasks, self.key) if tasks > 1 else both, self.key, self.order)
        return settled.join(keys, self.key, "left_anti").unionByName(replaced)

    def lookup(self, key: str) -> DataFrame:
        """The live row of one key: one bucket of the snapshot and the changes since are opened."""
        through, upto = self._extent()
        bucket = self.spark.range(1).select(self._bucket(F.lit(key)).alias("b")).first().b
        newest = self._newest_buckets()
        settled = self._settled({bucket: newest[bucket]} if bucket in newest else {})
        mine = F.col(self.key) == key
        return self._with(settled.where(mine), self._changes(self._log(through, upto)).where(mine))

    def compact(self) -> int:
        """Applies the changes to the buckets they touch; returns the position (-1: empty table)."""
        through, upto = self._extent()
        if upto <= through:
            return through
        log = self._log(through, upto)
        touched = [r.b for r in log.select(self._bucket(F.col(self.key)).alias("b")).distinct().collect()]
        settled = self._settled({b: t for b, t in self._newest_buckets().items() if b in set(touched)})
        tasks = self._tasks(log, settled)
        (
            self._with(settled, self._changes(log, tasks), tasks)
            .withColumn("bucket", self._bucket(F.col(self.key)))
            .hint("rebalance", "bucket")
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(f"{self.root}/snapshot/through={upto}")
        )
        return upto

    def vacuum(self, keep: int = 0) -> None:
        """Removes changes and buckets that newer snapshots replace.

        With `keep`, the newest snapshots before the last stay readable. Queries that read older
        ones fail, so run it when none does.
        """
        snapshots = self._finished("snapshot", "through=")
        if len(snapshots) <= keep:
            return
        readable = snapshots[len(snapshots) - 1 - keep]
        for position in self._numbers("changes", "position="):
            if position <= readable:
                files.remove_folder(self.spark, f"{self.root}/changes/position={position}")
        newest: dict[str, int] = {}
        for through in (s for s in snapshots if s <= readable):
            for bucket in self._names(f"snapshot/through={through}", "bucket="):
                if bucket in newest:
                    files.remove_folder(self.spark, f"{self.root}/snapshot/through={newest[bucket]}/bucket={bucket}")
                newest[bucket] = through
        for through in (s for s in snapshots if s < readable):
            if not self._names(f"snapshot/through={through}", "bucket="):
                files.remove_folder(self.spark, f"{self.root}/snapshot/through={through}")
