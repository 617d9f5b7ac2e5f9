"""Sharding along a Hilbert curve over several metadata dimensions.

Every dimension is quantised to the same number of levels, in the order of its
values, so that each level holds about as many rows; the levels become one Hilbert
index, rows are ordered by it and the order is cut into runs of equal row counts
(at most one apart). Neighbours on the curve are near in all dimensions, so each
shard covers a small box and files are pruned by a filter on any of them.

The table is read once, for the narrow columns; rows that agree in all of them are one
row with a count from there on. The rank of a row is the number of rows in smaller
cells, plus the rows of its cell in smaller hash bins, plus its place inside the bin.
There are at most 2**(bits * dimensions) cells, whatever the input; a cell has a bin for
each PER_BIN of its rows, and only inside bins rows are ordered, so neither a third of
all rows in one cell nor a group of equal texts or ids meets in one task.

Defined cases: null in a dimension is a level of its own before all values; null
texts have no bytes; ties are ordered by id; an empty table gives an empty result;
rows that repeat an id get different slots.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut

PER_BIN = 1_000


def hilbert_index(levels: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of points given as rows of integers below 2**bits."""
    x = [levels[:, i].astype(np.int64) for i in range(levels.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations of each scale, the largest first
        low = q - 1
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = x[0] ^ np.where(flip, low, swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x = [v ^ t for v in x]
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = (out << 1) | ((v >> b) & 1)
    return out


def before(df: DataFrame, column: str, n: str) -> DataFrame:
    """df with _before, the sum of n over all rows of smaller values of a column that has
    no value twice (null: the least): sums of ranges first, then sums inside a range."""
    ranges = cut(df.repartitionByRange(F.col(column).asc_nulls_first()).withColumn("_range", F.spark_partition_id()))
    ahead = Window.rowsBetween(Window.unboundedPreceding, -1)
    sums = ranges.groupBy("_range").agg(F.sum(n).alias("_sum"))  # a row for each partition
    sums = sums.select(F.col("_range").alias("_r"), F.coalesce(F.sum("_sum").over(ahead.orderBy("_range")), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_range").orderBy(F.col(column).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    out = ranges.join(F.broadcast(sums), F.col("_range") == F.col("_r"))
    return out.withColumn("_before", F.col("_base") + F.coalesce(F.sum(n).over(inside), F.lit(0))).drop("_range", "_r", "_base")


def quantise(points: DataFrame, column: str, bits: int, total: int) -> DataFrame:
    """_value, _level of each distinct value of a column: equal shares of the rows, of
    which points has the counts in ``_n``."""
    counts = before(points.groupBy(column).agg(F.sum("_n").alias("_n")), column, "_n")
    level = F.least(F.floor(F.col("_before") * (1 << bits) / F.lit(max(total, 1))), F.lit((1 << bits) - 1)).cast("int")
    return counts.select(F.col(column).alias("_value"), level.alias("_level"))


def shard(docs: DataFrame, dimensions: dict[str, Column], shards: int = 16, bits: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, hilbert, shard and slot of every row of docs.

    dimensions: named columns, for instance a language, a host or the logarithm of a
    length.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *[c.alias(f"_d{i}") for i, c in enumerate(dimensions.values())],
    )
    dims = [f"_d{i}" for i in range(len(dimensions))]
    rows = cut(rows.groupBy("_id", "size", "text_crc32", *dims).agg(F.count(F.lit(1)).alias("_n")))

    @F.pandas_udf("long")
    def index(*levels: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([v.to_numpy() for v in levels], axis=1), bits))

    # a level for each value, then an index for each combination of values that occurs
    points = cut(rows.groupBy(*dims).agg(F.sum("_n").alias("_n")))
    total = points.agg(F.sum("_n")).first()[0] or 0
    for i, d in enumerate(dims):
        points = points.join(quantise(points.select(d, "_n"), d, bits, total).withColumnsRenamed({"_value": f"_v{i}", "_level": f"_l{i}"}), F.col(d).eqNullSafe(F.col(f"_v{i}")))
    points = cut(points.withColumn("hilbert", index(*[f"_l{i}" for i in range(len(dims))])).select(*[F.col(d).alias(f"_p{i}") for i, d in enumerate(dims)], "hilbert", "_n"))

    # rows before each cell: a bounded number of cells
    cells = points.groupBy("hilbert").agg(F.sum("_n").alias("_n"))
    ahead = Window.orderBy("hilbert").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(F.col("hilbert").alias("_cell"), F.ceil(F.col("_n") / PER_BIN).alias("_bins"), F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_base"))
    on = F.lit(True)
    for i, d in enumerate(dims):
        on &= F.col(d).eqNullSafe(F.col(f"_p{i}"))
    rows = rows.join(points.drop("_n"), on).join(F.broadcast(cells), F.col("hilbert") == F.col("_cell"))
    # rows that are equal in all of this are one so far: cut in two steps into pieces of
    # PER_BIN, so that no array or task has more than that of them at a time
    for name, most in (("_far", PER_BIN * PER_BIN), ("_near", PER_BIN)):
        rows = rows.withColumn(name, F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / most))))
        rows = rows.withColumn("_n", F.least(F.lit(most), F.col("_n") - F.col(name) * most))
    rows = rows.withColumn("_bin", F.pmod(F.xxhash64("_id", "size", "text_crc32", *dims, "_far", "_near"), F.col("_bins")))

    # rows before each bin of a cell
    bins = rows.groupBy("hilbert", "_bin").agg(F.sum("_n").alias("_m"))
    order = Window.partitionBy("hilbert").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(F.col("hilbert").alias("_h"), F.col("_bin").alias("_b"), F.coalesce(F.sum("_m").over(order), F.lit(0)).alias("_early"))
    placed = rows.join(bins, (F.col("hilbert") == F.col("_h")) & (F.col("_bin") == F.col("_b")))
    inside = Window.partitionBy("hilbert", "_bin").orderBy("_id", "text_crc32", "size", *dims, "_far", "_near").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_first", F.col("_base") + F.col("_early") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    placed = placed.withColumn("_rank", F.explode(F.sequence("_first", F.col("_first") + F.col("_n") - 1)))

    # the first total % shards runs are one row longer
    longer, run = F.lit(total % shards), F.lit(total // shards)
    edge = longer * (run + 1)
    early = F.col("_rank") < edge
    number = F.when(early, F.floor(F.col("_rank") / (run + 1))).otherwise(longer + F.floor(F.try_divide(F.col("_rank") - edge, run)))
    first = F.when(F.col("shard") < longer, F.col("shard") * (run + 1)).otherwise(edge + (F.col("shard") - longer) * run)
    return (
        placed.withColumn("shard", number.cast("int"))
        .withColumn("slot", (F.col("_rank") - first).cast("long"))
        .select(F.col("_id").alias(id_col), "size", "text_crc32", "hilbert", "shard", "slot")
    )
