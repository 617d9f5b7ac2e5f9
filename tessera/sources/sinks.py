"""Writers: slices, snapshots and manifests."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _files(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the class of its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def write_slice(df: DataFrame, path: str, by: list[str], slices: DataFrame | None = None) -> None:
    """Replaces exactly the partitions that df has rows of: an idempotent recompute.

    slices: the slices that were computed anew, if some may be empty; those of them that
    df has no rows of are deleted. Their number is that of the folders.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    if slices is not None:
        escape = df.sparkSession.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        fs, make = _files(df.sparkSession, path)
        for row in slices.select(*[F.col(c).cast("string") for c in by]).distinct().join(df.select(*[F.col(c).cast("string") for c in by]).distinct(), by, "left_anti").collect():
            fs.delete(make("/".join([path, *(escape(c, row[c]) for c in by)])), True)


def content_hash(df: DataFrame) -> str:
    """A hash of the rows whatever their order, from one aggregation."""
    h = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"}))
    r = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(F.pmod(h, F.lit(1 << 40))).alias("s")).first()
    return f"{r.n}-{(r.x or 0) & (1 << 64) - 1:016x}-{r.s or 0}"


def write_if_changed(df: DataFrame, path: str, fmt: str = "json", known: str | None = None, **options: str) -> tuple[bool, str]:
    """Writes a snapshot unless its content hash is the known one: (written, hash)."""
    now = content_hash(df)
    if now == known:
        return False, now
    df.write.mode("overwrite").options(**options).format(fmt).save(path)
    return True, now


def export_parquet(tables: dict[str, DataFrame], folder: str, order: dict[str, list[str]] | None = None) -> list[dict]:
    """zstd files of each table, sorted inside partitions by its key; empty tables keep
    their schema. Returns the manifest."""
    manifest = []
    for name, df in tables.items():
        rows = df.sortWithinPartitions(*order[name]) if order and name in order else df
        rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}")
        written = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")
        hashed = content_hash(written)  # of what the files hold
        manifest.append({"table": name, "rows": int(hashed.split("-")[0]), "schema": json.loads(df.schema.json()), "hash": hashed})
    return manifest


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Moves a finished folder into place. The old one is set aside first, put back if the
    new one can't be moved in, and deleted only when it stands."""
    fs, make = _files(spark, staged)
    here, there, aside = make(staged), make(target), make(f"{target}.old")
    if not fs.exists(make(staged, "_SUCCESS")):
        raise ValueError(f"{staged} is not a finished output")
    had = fs.exists(there)
    if had:
        fs.delete(aside, True)
        if not fs.rename(there, aside):
            raise OSError(f"{target} can't be set aside")
    if not fs.rename(here, there):
        if had:
            fs.rename(aside, there)
        raise OSError(f"{staged} can't be moved to {target}")
    if had:
        fs.delete(aside, True)


def recorded(spark: SparkSession, ledger: str, run_id: str, source: str, load: Callable[[], DataFrame], staged: str, target: str, least: int = 0) -> str:
    """A load as a whole or not at all, with a row in the ledger (run_id, source, status,
    rows, error, at): its result is staged and published only if it has ``least`` rows;
    what fails leaves the target as it was. Returns the status, ``ok`` or ``failed``."""
    status, rows, error = "ok", None, None
    try:
        load().write.mode("overwrite").parquet(staged)
        rows = spark.read.parquet(staged).count()
        if rows < least:
            raise ValueError(f"{rows} rows, {least} are needed")
        publish(spark, staged, target)
    except Exception as e:  # the ledger says what happened, whatever it was
        status, error = "failed", f"{type(e).__name__}: {e}"[:500]
    entry = spark.createDataFrame([(run_id, source, status, rows, error)], "run_id string, source string, status string, rows long, error string")
    entry.withColumn("at", F.current_timestamp()).write.mode("append").parquet(ledger)
    return status
