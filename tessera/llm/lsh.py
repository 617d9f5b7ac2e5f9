"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are searched by inner product. Divided by the largest norm and given one
more coordinate that makes their length 1, their order by inner product with a query
is their order by Euclidean distance from it; that space is hashed. A table's key is
``hashes`` values floor((a.x + b) / width) with Gaussian a. A query looks into its own
bucket and into the buckets whose keys differ by one step in some values, in the order
of estimated success: least sum of squared distances to the crossed edges first.

All candidates of a bucket are scored exactly, in double precision, on the original
vectors, and the best of each partition are merged. A query for which the tables give
too few candidates is compared with every vector, in blocks, so none goes short.

The number of hashes grows with the logarithm of the number of vectors, and the probes
with it (``sized``): the nearest of more vectors are nearer, so buckets may be smaller.

Groups of copies: of equal vectors the ``k + 1`` smallest ids stand for all, which is
exact: a list of k neighbours with ties to smaller ids can't reach further. Equal
queries are searched once.

Defined cases: vectors that are null, zero, of another dimension than most, or hold
null or non-finite components take no part, as query or candidate, nor do rows without
an id; rows that repeat an id, with equal or different vectors, are candidates of their
own and queries of their own, each without itself alone, so such an id has as many
lists; ties of score and id have no order; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut

TABLES = 12
WIDTH = 2.0
PART = 100_000
SEED = 7
_FOUND = "qc long, vec_id long, rid long, score double"


def sized(n: int) -> tuple[int, int]:
    """Hashes of a table and probes into it for n vectors: one hash more for each
    fivefold of 2,000, half as many probes again for each hash more."""
    more = max(0, round(math.log(max(n, 1) / 2000, 5)))
    return 8 + more, round(64 * 1.5**more)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, v, norm2 and rid, a number for each row, of the vectors that take part."""
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    norm2 = F.aggregate("v", F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).filter(F.col("id").isNotNull() & good)
    rows = rows.withColumn("norm2", norm2).filter("norm2 > 0")
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
    return rows.join(F.broadcast(common.select("d")), F.size("v") == F.col("d"), "left_semi").withColumn("rid", F.monotonically_increasing_id())


def planes(dim: int, tables: int, hashes: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.normal(size=(dim, tables * hashes)), rng.uniform(0, 1, tables * hashes)


def steps(hashes: int, changed: int = 3) -> np.ndarray:
    """All ways to move up to ``changed`` of the values by one step."""
    out = [np.zeros(hashes, np.int64)]
    for n in range(1, changed + 1):
        for at in combinations(range(hashes), n):
            for by in product((-1, 1), repeat=n):
                step = np.zeros(hashes, np.int64)
                step[list(at)] = by
                out.append(step)
    return np.array(out)


def _codes(cells: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A 64-bit key of a table's cell."""
    code = table.astype(np.uint64) + np.uint64(1)
    for i in range(cells.shape[-1]):
        code = (code ^ cells[..., i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    return code


def _stack(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(len(column), -1)


def search(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", tables: int = TABLES, hashes: int | None = None, width: float = WIDTH, probes: int | None = None, seed: int = SEED) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row that ``queries``
    (a condition on the column ``id``) picks, without the row itself."""
    rows = cut(usable(vectors, id_col, vec_col))
    first = Window.partitionBy(F.xxhash64("v"), "v").orderBy("id", "rid")
    base = rows.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= k + 1).select("id", "v", "norm2", "rid")
    asked = cut(rows.filter(queries).groupBy("v", "norm2").agg(F.min("rid").alias("qc")).select("qc", "v", "norm2"))
    top = rows.agg(F.max("norm2").alias("top"))
    n = rows.count()
    hashes, probes = hashes or sized(n)[0], probes or sized(n)[1]
    # parts of the exchange: each holds about PART vectors at a time
    spread = max(8, -(-n * tables // PART))
    element = rows.schema["v"].dataType.elementType.simpleString()

    def project(v: np.ndarray, extra: np.ndarray) -> np.ndarray:
        a, b = planes(v.shape[1] + 1, tables, hashes, seed)
        return ((np.concatenate([v, extra[:, None]], axis=1) @ a) / width + b).reshape(len(v), tables, hashes)

    def emit(kind: int, ids: np.ndarray, rids: np.ndarray, v: pa.Array, code: np.ndarray) -> pa.RecordBatch:
        """A row for each vector and part of the exchange, with its codes there."""
        part = (code % np.uint64(spread)).astype(np.int64)
        order = np.argsort(part, axis=1, kind="stable")
        row = np.repeat(np.arange(len(ids)), code.shape[1])
        part, code = np.take_along_axis(part, order, 1).reshape(-1), np.take_along_axis(code, order, 1).reshape(-1)
        new = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (row[1:] != row[:-1])]))
        offsets = np.append(new, len(part)).astype(np.int32)
        codes = pa.ListArray.from_arrays(pa.array(offsets), pa.array(code.view(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(part[new].astype(np.int32)), pa.array(np.full(len(new), kind, np.int32)), pa.array(ids[row[new]]), pa.array(rids[row[new]]), v.take(pa.array(row[new])), codes], ["part", "kind", "id", "rid", "v", "codes"])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows_ = batch.slice(at, 500)
                v, big = _stack(rows_.column(1)), rows_.column(4).to_numpy()
                cells = np.floor(project(v / np.sqrt(big)[:, None], np.sqrt(np.maximum(0, 1 - rows_.column(2).to_numpy() / big)))).astype(np.int64)
                yield emit(0, rows_.column(0).to_numpy(), rows_.column(3).to_numpy(), rows_.column(1), _codes(cells, np.arange(tables)[None, :]))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves = steps(hashes)
        take = min(probes, len(moves))
        below, above = (moves.T == -1).astype(float), (moves.T == 1).astype(float)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows_ = batch.slice(at, 64)
                v = _stack(rows_.column(1))
                place = project(v / np.sqrt(rows_.column(2).to_numpy())[:, None], np.zeros(len(v)))
                cells = np.floor(place)
                inside = place - cells
                # squared distances to the edges that a move crosses
                cost = inside**2 @ below + (1 - inside) ** 2 @ above
                best = np.argpartition(cost, take - 1, axis=2)[:, :, :take]
                code = _codes(cells[:, :, None, :].astype(np.int64) + moves[best], np.arange(tables)[None, :, None])
                yield emit(1, rows_.column(0).to_numpy(), rows_.column(0).to_numpy(), rows_.column(1), code.reshape(len(v), -1))

    def trim(q: np.ndarray, c: np.ndarray, rough: np.ndarray, n: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (q, c) that may be among the k + 1 best of q, once each; floor gets the
        score that a pair of q must reach from now on."""
        pair = np.unique(q * n + c, return_index=True)[1]
        q, c, rough = q[pair], c[pair], rough[pair]
        order = np.lexsort((-rough, q))
        q, c, rough = q[order], c[order], rough[order]
        start = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
        size = np.diff(np.append(start, len(q)))
        full = size > k
        least = rough[start[full] + k]
        floor[q[start[full]]] = least - 1e-9 * np.maximum(1, np.abs(least))
        near = rough >= floor[q]
        return q[near], c[near], rough[near]

    def exactly(q: np.ndarray, c: np.ndarray, qv: np.ndarray, cv: np.ndarray, qids: np.ndarray, cids: np.ndarray, rids: np.ndarray) -> pa.RecordBatch:
        """The k + 1 best of each query, by score and id, scored on the vectors."""
        score = np.concatenate([(qv[q[i : i + 50_000]] * cv[c[i : i + 50_000]]).sum(axis=1) for i in range(0, max(len(q), 1), 50_000)])
        order = np.lexsort((rids[c], cids[c], -score, q))
        q, c, score = q[order], c[order], score[order]
        start = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
        size = np.diff(np.append(start, len(q)))
        good = np.arange(len(q)) - np.repeat(start, size) <= k
        return pa.RecordBatch.from_arrays([pa.array(qids[q[good]]), pa.array(cids[c[good]]), pa.array(rids[c[good]]), pa.array(score[good])], ["qc", "vec_id", "rid", "score"])

    def nearest(blocks: Iterator[tuple[np.ndarray, np.ndarray]], qv: np.ndarray, cv: np.ndarray, qids: np.ndarray, cids: np.ndarray, rids: np.ndarray) -> pa.RecordBatch:
        """The best candidates of each query over blocks of (queries, candidates)."""
        floor = np.full(len(qv), -np.inf)
        have, held, limit = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], 0, 100_000
        for qs, cs in blocks:
            scores = qv[qs] @ cv[cs].T
            i, j = np.nonzero(scores >= floor[qs][:, None])
            have.append((qs[i], cs[j], scores[i, j]))
            held += len(i)
            if held > limit:
                have = [trim(*(np.concatenate(x) for x in zip(*have, strict=True)), len(cv), floor)]
                held = len(have[0][0])
                limit = max(limit, 2 * held)
        q, c, _ = trim(*(np.concatenate(x) for x in zip(*have, strict=True)), len(cv), floor)
        return exactly(q, c, qv, cv, qids, cids, rids)

    def shared_buckets(ccode: np.ndarray, crow: np.ndarray, qcode: np.ndarray, qrow: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        shared = np.intersect1d(ccode, qcode)
        edges = [np.searchsorted(x, shared, side) for x in (ccode, qcode) for side in ("left", "right")]
        for c0, c1, q0, q1 in zip(*(e.tolist() for e in edges), strict=True):
            for c in range(c0, c1, 4096):  # a bucket of any size is met in blocks
                for q in range(q0, q1, 256):
                    yield qrow[q : min(q + 256, q1)], crow[c : min(c + 4096, c1)]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_part(batches):
            kind = part.column("kind").to_numpy()
            sides = []
            for side in (0, 1):
                rows_ = part.filter(pa.array(kind == side))
                codes = rows_.column("codes").combine_chunks()
                code, row = codes.flatten().to_numpy(), np.repeat(np.arange(len(rows_)), codes.value_lengths().to_numpy())
                order = np.argsort(code, kind="stable")
                sides.append((rows_.column("id").to_numpy(), rows_.column("rid").to_numpy(), _stack(rows_.column("v").combine_chunks()) if len(rows_) else None, code[order], row[order]))
            (cids, rids, cv, ccode, crow), (qids, _, qv, qcode, qrow) = sides
            if len(cids) and len(qids):
                yield nearest(shared_buckets(ccode, crow, qcode, qrow), qv, cv, qids, cids, rids)

    def merged(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("qc").orderBy(F.desc("score"), "vec_id", "rid")
        once = found.groupBy("qc", "vec_id", "rid").agg(F.max("score").alias("score"))
        return once.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k + 1).drop("_n")

    exchange = f"part int, kind int, id long, rid long, v array<{element}>, codes array<long>"
    sides = base.crossJoin(F.broadcast(top)).mapInArrow(index, exchange).union(asked.mapInArrow(probe, exchange))
    found = cut(merged(sides.repartition("part").sortWithinPartitions("part").mapInArrow(meet, _FOUND)))

    # queries that the tables leave short see every vector; usually there are none
    full = found.groupBy("qc").count().filter(F.col("count") > k).withColumnRenamed("qc", "_full")
    short = asked.join(full, F.col("qc") == F.col("_full"), "left_anti")
    if not short.isEmpty():

        def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return pa.table({"qc": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "rid": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
            cids, rids, cv = left.column("id").to_numpy(), left.column("rid").to_numpy(), _stack(left.column("v").combine_chunks())
            qids, qv = right.column("qc").to_numpy(), _stack(right.column("qv").combine_chunks())
            every = ((np.arange(q, min(q + 256, len(qv))), np.arange(c, min(c + 8192, len(cv)))) for q in range(0, len(qv), 256) for c in range(0, len(cv), 8192))
            return pa.Table.from_batches([nearest(every, qv, cv, qids, cids, rids)])

        dealt = base.select("id", "rid", "v", F.pmod(F.xxhash64("rid"), F.lit(spread)).alias("block"))
        everywhere = short.select("qc", F.col("v").alias("qv"), F.explode(F.sequence(F.lit(0), F.lit(spread - 1)).cast("array<long>")).alias("block"))
        exact = dealt.groupBy("block").cogroup(everywhere.groupBy("block")).applyInArrow(compare, _FOUND)
        found = merged(found.union(exact))

    # back to every query: its copies share the list, each without itself
    own = rows.filter(queries).select(F.col("id").alias("query_id"), F.col("rid").alias("_own"), F.col("v").alias("_qv"))
    named = own.join(asked.select("qc", "v"), F.col("_qv") == F.col("v")).select("query_id", "_own", F.col("qc").alias("_qc"))
    order = Window.partitionBy("_own").orderBy(F.desc("score"), "vec_id", "rid")
    listed = named.join(found, F.col("_qc") == F.col("qc")).filter("rid != _own").withColumn("rank", F.row_number().over(order))
    return listed.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by ``part``, one table for each part."""
    here, held = None, []
    for batch in batches:
        parts = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            if lo == hi:
                continue
            if parts[lo] != here and held:
                yield pa.Table.from_batches(held)
                held = []
            here = parts[lo]
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)
