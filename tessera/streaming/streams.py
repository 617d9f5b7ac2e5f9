"""Streaming forms of the log operators, for Structured Streaming.

Each takes a streaming frame with an event time and returns one, with a watermark that
bounds its state; ``run_into`` drives one over what is there, stops, and goes on there the
next time.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..functions.scalars import micros


def file_stream(spark: SparkSession, path: str, files_per_batch: int = 8) -> DataFrame:
    """A stream of Parquet files with the schema of those that are there. The path is given
    as a pattern, so it may also name a single file."""
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{path[:-1]}[{path[-1]}]")
    # event times need an instant; files may hold local times
    return stream.withColumns({f.name: F.col(f.name).cast("timestamp") for f in schema.fields if f.dataType.typeName() == "timestamp_ntz"})


def folder(spark: SparkSession) -> str:
    """A new folder for results and progress under the shared checkpoint folder."""
    base = spark.sparkContext.getCheckpointDir() or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="spark-stream-")
    return f"{base}/stream-{uuid.uuid4().hex}"


def windowed(stream: DataFrame, at: str, keys: list[str], value: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by key and tumbling window."""
    g = stream.withWatermark(at, late).groupBy(F.window(at, width), *keys)
    return g.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("decimal(18,2)")).alias("total")).select(F.col("window.start").alias("start"), *keys, "n", "total")


def idempotent(stream: DataFrame, at: str, key: str, late: str = "1 day") -> DataFrame:
    """Each key once, within the watermark: repeated appends do nothing."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def sessions(stream: DataFrame, at: str, keys: list[str], gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """Sessions by a gap of inactivity."""
    g = stream.withWatermark(at, late).groupBy(F.session_window(at, gap), *keys)
    return g.agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first"), F.max(at).alias("last")).drop("session_window")


class _LastN(StatefulProcessor):
    """The newest n rows of a key as a list; with ``idle``, a timer that drops a key so long
    after its newest row."""

    def __init__(self, n: int, idle_ms: int | None):
        self.n, self.idle = n, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "at bigint, value double")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        kept = [tuple(r) for r in self.rows.get()]
        for part in rows:
            kept += list(zip(part["at"].tolist(), part["value"].tolist(), strict=True))
            kept = sorted(kept)[-self.n :]
        self.rows.put(kept)
        if self.idle is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(kept[-1][0] // 1000 + self.idle)
        yield pd.DataFrame({"key": [key[0]], "n": [len(kept)], "mean": [sum(v for _, v in kept) / len(kept)], "newest": [kept[-1][0]]})

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.rows.clear()
        return iter(())

    def close(self) -> None:
        pass


def last_n(stream: DataFrame, key: str, at: str, value: str, n: int = 20, idle_seconds: int | None = None, late: str = "1 day") -> DataFrame:
    """After each batch, mean and count of the newest n values of the keys it brought; the
    state of a key is n rows. With ``idle_seconds`` a key without rows for so long, by the
    watermark, is forgotten."""
    rows = stream.select(F.col(at).alias("_time"), F.col(key).cast("string").alias("key"), micros(at).alias("at"), F.col(value).cast("double").alias("value"))
    if idle_seconds is not None:
        rows = rows.withWatermark("_time", late)
    processor = _LastN(n, None if idle_seconds is None else 1000 * idle_seconds)
    return rows.groupBy("key").transformWithStateInPandas(processor, "key string, n long, mean double, newest long", "Update", "None" if idle_seconds is None else "EventTime")


ROCKS = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Ledger:
    """The batches that are committed in a folder: a file for each names the version that
    the batch left. It appears by one rename, after the version is whole."""

    def __init__(self, spark: SparkSession, out: str):
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.files = self.path(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.out = out

    def batches(self) -> list[int]:
        at = self.path(f"{self.out}/ledger")
        return sorted(int(f.getPath().getName()) for f in self.files.listStatus(at) if f.getPath().getName().isdigit()) if self.files.exists(at) else []

    def commit(self, number: int) -> None:
        mark = self.path(f"{self.out}/ledger/.{uuid.uuid4().hex}")
        self.files.create(mark).close()
        if not self.files.rename(mark, self.path(f"{self.out}/ledger/{number}")):
            raise RuntimeError(f"batch {number} of {self.out} could not be committed")

    def version(self, number: int) -> str:
        return f"{self.out}/v{number}"

    def drop(self, number: int) -> None:
        self.files.delete(self.path(self.version(number)), True)


Merge = Callable[[DataFrame | None, DataFrame], DataFrame]


def run_into(stream: DataFrame, out: str, mode: str = "append", merge: Merge | None = None) -> DataFrame:
    """Runs over all that is there and returns the result so far, all of it.

    ``out`` names the folder of progress, versions and ledger. A later call with the same
    folder goes on where the one before ended or failed: what was read is not read again, and
    a batch that ran but whose progress was lost is not applied twice. ``merge`` combines the
    result so far with a batch; each batch is a new version, of which the last two are kept.
    A stream without rows gives an empty result of its schema.
    """
    spark = stream.sparkSession
    ledger = Ledger(spark, out)

    def write(batch: DataFrame, number: int) -> None:
        done = ledger.batches()
        if number in done:
            return
        if merge is not None:
            batch = merge(batch.sparkSession.read.parquet(ledger.version(done[-1])) if done else None, batch)
        batch.write.mode("overwrite").parquet(ledger.version(number))
        ledger.commit(number)
        if merge is not None:
            for old in done[:-1]:
                ledger.drop(old)

    before = spark.conf.get(ROCKS[0], None)
    spark.conf.set(*ROCKS)  # list state and timers need it
    try:
        query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{out}/progress").trigger(availableNow=True).foreachBatch(write).start()
        query.awaitTermination()
    finally:
        spark.conf.unset(ROCKS[0]) if before is None else spark.conf.set(ROCKS[0], before)
    done = ledger.batches()
    if not done:
        return spark.createDataFrame([], stream.schema)
    if mode == "append" and merge is None:
        return spark.read.parquet(*[ledger.version(n) for n in done])
    return spark.read.parquet(ledger.version(done[-1]))


def run_available(stream: DataFrame, mode: str = "append", merge: Merge | None = None) -> DataFrame:
    """As run_into, in a new folder."""
    return run_into(stream, folder(stream.sparkSession), mode, merge)
