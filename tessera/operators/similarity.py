"""Similarity of groups by the sides they take, by blocks of bits.

The events of a scope are numbered and cut into blocks, its groups into tiles. A tile of a
block is two bit matrices: who said yes, who said no. Tiles of one block meet in pairs, and
AND and population count give what all their groups share; the counts are summed over the
blocks. So a pair of groups costs a row for each block of ``EVENTS`` events, not one for
each event, and the pieces are bounded however many rows a group has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranges import null_safe, ranked

#: Events of a block and groups of a tile; 64 KB of bits for each side.
EVENTS = 8192
GROUPS = 64


def sign_vectors(counts: DataFrame, scope: list[str], group: str, event: str, least: int) -> DataFrame:
    """scope, group, event, sign: +1 or -1 by majority; ties and groups with fewer than
    ``least`` events in the scope drop out."""
    sign = F.when(F.col("yes") > F.col("no"), 1).when(F.col("no") > F.col("yes"), -1)
    signed = counts.select(*scope, group, event, sign.alias("sign")).filter("sign is not null")
    own = [*scope, group]
    enough = signed.groupBy(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(own)]).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least)
    return signed.join(enough, null_safe(own, [f"_o{i}" for i in range(len(own))]), "left_semi")


def _tiles(vectors: DataFrame, scope: list[str], group: str, event: str) -> tuple[DataFrame, DataFrame]:
    """(scope nr, block, tile, yes, no) with the bits of GROUPS groups each, and the groups
    with their numbers and counts. Vectors have one row for a group and event."""
    names = [f"_s{i}" for i in range(len(scope))]
    rows = vectors.select(*[F.col(c).alias(n) for c, n in zip(scope, names, strict=True)], F.col(group).alias("_g"), F.col(event).alias("_e"), "sign")
    groups = rows.groupBy(*names, "_g").agg(F.count_if(F.col("sign") > 0).alias("_yes"), F.count_if(F.col("sign") < 0).alias("_no"))
    groups = groups.withColumn("_gn", F.row_number().over(Window.partitionBy(*names).orderBy("_g")) - 1)
    events = ranked(rows.select(*names, "_e").distinct(), names, ["_e"], rank="_en")
    mine = lambda df, own: df.select(*[F.col(c).alias(f"{c}_x") for c in own], *[c for c in df.columns if c not in own])
    numbered = rows.join(mine(events, [*names, "_e"]), null_safe([*names, "_e"], [f"{c}_x" for c in [*names, "_e"]])).drop(*[f"{c}_x" for c in [*names, "_e"]])
    numbered = numbered.join(mine(groups, [*names, "_g"]), null_safe([*names, "_g"], [f"{c}_x" for c in [*names, "_g"]]))
    bits = numbered.select(*names, F.floor(F.col("_en") / EVENTS).alias("_block"), F.floor(F.col("_gn") / GROUPS).alias("_tile"), (F.col("_gn") % GROUPS).cast("int").alias("_row"), (F.col("_en") % EVENTS).cast("int").alias("_bit"), "sign")
    keys, shape = [*names, "_block", "_tile"], (GROUPS, EVENTS)

    def pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        row, bit, sign = (rows.column(c).to_numpy() for c in ("_row", "_bit", "sign"))
        out = {}
        for name, side in (("yes", 1), ("no", -1)):
            matrix = np.zeros(shape, np.uint8)
            matrix[row[sign == side], bit[sign == side]] = 1
            out[name] = pa.array([np.packbits(matrix, axis=1).tobytes()], pa.binary())
        return pa.table({k: rows.column(k)[:1] for k in keys} | out)

    schema = ", ".join(f"{k} {bits.schema[k].dataType.simpleString()}" for k in keys) + ", yes binary, no binary"
    return bits.groupBy(*keys).applyInArrow(pack, schema), groups


_COUNTS = ("shared", "yy", "nn")


def _meet(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """Counts of all pairs between two tiles of one block that share an event."""
    for batch in batches:
        fixed = batch.schema.names[: batch.num_columns - 6]
        for k in range(batch.num_rows):
            tile_a, tile_b, *raw = (batch.column(batch.num_columns - 6 + i)[k].as_py() for i in range(6))
            yes_a, no_a, yes_b, no_b = (np.frombuffer(x, np.uint64).reshape(groups, -1) for x in raw)
            own = (yes_a | no_a).any(axis=1).nonzero()[0]
            found = []
            for i in own.tolist():
                shared = np.bitwise_count((yes_a[i] | no_a[i]) & (yes_b | no_b)).sum(axis=1)
                others = np.flatnonzero(shared)
                others = others[others > i] if tile_a == tile_b else others
                if len(others):
                    agree = [np.bitwise_count(a[i] & b[others]).sum(axis=1) for a, b in ((yes_a, yes_b), (no_a, no_b))]
                    found.append([np.full(len(others), tile_a * groups + i), tile_b * groups + others, shared[others], *agree])
            if found:
                columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found, strict=True)]
                same = [pa.concat_arrays([batch.column(f)[k : k + 1]] * len(columns[0])) for f in range(len(fixed))]
                yield pa.RecordBatch.from_arrays([*same, *columns], [*fixed, "_a", "_b", *_COUNTS])


def pair_similarity(vectors: DataFrame, scope: list[str], group: str, event: str, least_shared: int = 1) -> DataFrame:
    """scope, a, b, shared, cosine, jaccard of the groups a < b of a scope that share events:
    cosine over shared events and Jaccard of the sides over all events of both. Null groups
    take part; a group with two rows for an event counts both sides there."""
    tiles, groups = _tiles(vectors, scope, group, event)
    names = [f"_s{i}" for i in range(len(scope))]
    other = tiles.select(*[F.col(c).alias(f"{c}_x") for c in [*names, "_block"]], F.col("_tile").alias("tile_b"), F.col("yes").alias("yes_b"), F.col("no").alias("no_b"))
    met = tiles.join(other, null_safe([*names, "_block"], [f"{c}_x" for c in [*names, "_block"]]) & (F.col("_tile") <= F.col("tile_b")))
    met = met.select(*names, F.col("_tile").alias("tile_a"), "tile_b", "yes", "no", "yes_b", "no_b")
    schema = ", ".join([*(f"{n} {vectors.schema[c].dataType.simpleString()}" for n, c in zip(names, scope, strict=True)), *(f"{c} long" for c in ("_a", "_b", *_COUNTS))])
    groups_of_tile = GROUPS
    pairs = met.mapInArrow(lambda batches: _meet(batches, groups_of_tile), schema).groupBy(*names, "_a", "_b").agg(*[F.sum(c).alias(c) for c in _COUNTS]).filter(F.col("shared") >= least_shared)

    def named(df: DataFrame, side: str) -> DataFrame:
        own = groups.select(*[F.col(n).alias(f"{n}_x") for n in names], F.col("_gn").alias("_n"), F.col("_g").alias(side), F.col("_yes").alias(f"_yes{side}"), F.col("_no").alias(f"_no{side}"))
        return df.join(own, null_safe([*names, f"_{side}"], [*(f"{n}_x" for n in names), "_n"])).drop("_n", *[f"{n}_x" for n in names])

    out = named(named(pairs, "a"), "b")
    agree = F.col("yy") + F.col("nn")
    union = (F.col("_yesa") + F.col("_yesb") - F.col("yy")) + (F.col("_noa") + F.col("_nob") - F.col("nn"))
    cosine = (2 * agree - F.col("shared")) / F.col("shared")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, scope, strict=True)], "a", "b", "shared", cosine.alias("cosine"), F.coalesce(F.try_divide(agree.cast("double"), union), F.lit(0.0)).alias("jaccard"))


def issue_coalitions(by_topic: DataFrame, overall: DataFrame, high: float = 0.75, low: float = 0.40, scope: list[str] | None = None) -> DataFrame:
    """Pairs that agree on a topic but not overall in their scope; no overall figure counts
    as 0. ``scope``: columns of both frames within which ``overall`` holds."""
    keys = [*(scope or []), "a", "b"]
    known = overall.select(*keys, F.col("cosine").alias("_all"))
    return by_topic.join(known, keys, "left").withColumn("overall", F.coalesce("_all", F.lit(0.0))).filter((F.col("cosine") >= high) & (F.col("overall") <= low)).drop("_all")
