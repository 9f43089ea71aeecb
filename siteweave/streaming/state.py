"""Structured Streaming forms of the polled batch jobs."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructField, StructType

from siteweave.operators.crossmatch import latest

#: Buckets of the kept table: a micro-batch rewrites those that it has keys of.
BUCKETS = 64


def new_records(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A folder of JSON landings as a stream; with the trigger availableNow it polls as the cron job does."""
    return spark.readStream.schema(schema).json(folder)


def latest_per_key(stream: DataFrame, key: str, ts: str, table: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Keep the newest row of each key in a Parquet table of buckets of the key.

    A micro-batch merges the buckets that it touches into new files below the batch's number, and then names these as the
    buckets' present ones; a batch that is run again writes the same. read_latest() reads the table.
    """

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        dealt = batch.withColumn("_b", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).persist()
        touched = [r[0] for r in dealt.select("_b").distinct().collect()]  # BUCKETS numbers at most
        present = {b: v for b, v in _present(spark, table).items() if v < epoch}
        new = dealt.withColumn("_o", F.lit(1))
        old = [f"{table}/v{present[b]}/_b={b}" for b in touched if b in present]
        if old:
            before = spark.read.schema(batch.schema).option("basePath", table).parquet(*old).select(*batch.columns)
            new = before.withColumns({"_b": F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"), "_o": F.lit(0)}).unionByName(new)
        latest(new, key, ts, "_o").drop("_o").repartition("_b").write.mode("overwrite").partitionBy("_b").parquet(f"{table}/v{epoch}")
        named = spark.createDataFrame([(b, int(epoch)) for b in touched], "b int, v long") if touched else spark.createDataFrame([], "b int, v long")
        named.coalesce(1).write.mode("overwrite").json(f"{table}/names/v{epoch}")
        dealt.unpersist()

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class _Newest(StatefulProcessor):
    """Keeps the newest row of a key and gives it whenever it changes; the row that came first wins ties."""

    def __init__(self, columns: list[str], ts: str, schema: str, keep_ms: int | None) -> None:
        self.columns, self.ts, self.schema, self.keep_ms = columns, ts, schema, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        at = self.columns.index(self.ts)
        age = lambda row: float("-inf") if row[at] is None else row[at]
        before = self.kept.get() if self.kept.exists() else None
        best = before
        for row in rows:
            values = tuple(row[c] for c in self.columns)
            if best is None or age(values) > age(best):
                best = values
        if self.keep_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer[0])
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.keep_ms)
        if best is not before:
            self.kept.update(tuple(best))
            yield Row(**dict(zip(self.columns, best, strict=True)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        self.kept.clear()
        return iter(())

    def close(self) -> None:
        pass


def newest_rows(stream: DataFrame, key: str, ts: str, keep_ms: int | None = None) -> DataFrame:
    """A stream of changes: a row of each key whenever a newer one (ts, a number; null is oldest) has come. Write it in update mode.

    Each key's newest row is its state, in the state store's partitions, so a batch touches only its own keys, a repeated or late
    row changes nothing, and old versions go with the store's own retention. keep_ms: a key without rows for so long is forgotten;
    with the trigger availableNow such a query waits for its timers and doesn't end.
    read_newest() reads all keys from the checkpoint. Rows without a key are left out.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema = StructType([StructField(f.name, f.dataType) for f in stream.schema.fields])
    worker = _Newest(stream.columns, ts, schema, keep_ms)
    return stream.where(F.col(key).isNotNull()).groupBy(key).transformWithState(worker, schema, "Update", "None" if keep_ms is None else "ProcessingTime")


def read_newest(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The newest row of each key as the last finished batch of newest_rows() left it."""
    return spark.read.format("statestore").option("stateVarName", "kept").load(checkpoint).select("value.*")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _present(spark: SparkSession, table: str) -> dict[int, int]:
    """The batch that wrote each bucket last."""
    if not _exists(spark, f"{table}/names"):
        return {}
    names = spark.read.schema("b int, v long").option("recursiveFileLookup", "true").json(f"{table}/names")
    return dict(names.groupBy("b").agg(F.max("v")).collect())  # a row for each bucket


def read_latest(spark: SparkSession, table: str) -> DataFrame:
    """The rows that latest_per_key() keeps."""
    paths = [f"{table}/v{v}/_b={b}" for b, v in sorted(_present(spark, table).items())]
    if not paths:
        raise FileNotFoundError(f"{table} holds no batch yet")
    return spark.read.parquet(*paths)


def windowed_counts(stream: DataFrame, ts: str, kind: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), kind).agg(F.count(F.lit(1)).alias("n"))
