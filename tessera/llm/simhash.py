"""Near-duplicate documents by SimHash and pigeonhole blocks.

A fingerprint bit is set if it is set in over half the hashes of a text's word
shingles. Fingerprints link at ``distance`` or fewer differing bits. They are cut
into ``pieces`` blocks; a close pair differs in at most ``distance`` blocks, so it
shares the other ones: there is a key for every choice of ``pieces - distance``
blocks, equal keys meet, and the Hamming distance is verified there.

The number of blocks follows from the number of fingerprints: more blocks give more
keys, but longer ones, so that the group of a key doesn't grow with the corpus.

Equal fingerprints are joined beforehand by a combined aggregation, so groups of
copies cost one row. Where many different fingerprints share a key, a breadth-first
walk gives links that keep the group connected as it is, fewer than it has members;
very large groups are split once more by blocks of the bits that are left. Such links are
enough for components by distance alone; ``keep_one``, which also asks for similarity,
goes on from the parts that failed links leave until no pair between them is left.

Defined cases: null and empty texts have fingerprint 0 and link like any other; texts
shorter than a shingle are one shingle; long texts are taken whole; repeated rows and
ties fall into one component; an empty table gives an empty result; extra columns
are not looked at by ``fingerprints`` and kept by ``keep_one``. Null ids are ids like
others: their rows have a null component unless they reach an id, and are not reached by
their being null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .ids import require_integers
from .lineage import cut
from .words import LOWER, Block, blocks, window_hash

SHINGLE = 3
DISTANCE = 3
SEED = 42
_SPLIT_ABOVE = 2048
_SMALL = 64
#: Cost of a comparison with a member of the group, walks of large groups included,
#: against that of exchanging a row.
_COMPARE = 0.05
_BITS = (256, 1 << 16)
_EPSILON = 1e-6
_LANES = np.uint64(0x0101010101010101)


def block_fingerprints(block: Block, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The fingerprint of each document of a block."""
    joined, place = block.joined(lower=True)
    text = joined.tobytes()

    n = block.n_words
    count = np.where(n == 0, 0, np.maximum(n - shingle + 1, 1))
    offsets = np.concatenate([[0], np.cumsum(count)])
    first = np.arange(offsets[-1]) + np.repeat(block.word_offsets[:-1] - offsets[:-1], count)
    last = first + np.repeat(np.minimum(n, shingle), count) - 1
    digest = xxhash.xxh64_intdigest
    spans = zip(place[first].tolist(), (place[last + 1] - 1).tolist(), strict=True)
    hashes = np.fromiter((digest(text[a:b], seed) for a, b in spans), np.uint64, len(first))

    # bits of up to 255 hashes are added eight at a time, one in each byte of a word
    full = np.flatnonzero(count)
    out = np.zeros(block.n_docs, np.uint64)
    if not len(full):
        return out
    runs = -(-count[full] // 255)
    run_offsets = np.concatenate([[0], np.cumsum(runs)])
    starts = np.repeat(offsets[full], runs) + 255 * (np.arange(run_offsets[-1]) - np.repeat(run_offsets[:-1], runs))
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, starts)
        ones = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), run_offsets[:-1], axis=0)
        major = 2 * ones > count[full][:, None]
        for byte in range(8):
            out[full] |= major[:, byte].astype(np.uint64) << np.uint64(8 * byte + bit)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """id and fp, the fingerprint's 64 bits as a long; one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [block_fingerprints(b, shingle, seed) for b in blocks(batch.column(1))]
            if parts:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts).view(np.int64))], ["_id", "fp"])

    id_type = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"_id {id_type}, fp long")
    return out.withColumnRenamed("_id", id_col)


def masks(pieces: int, distance: int, bits: int = 64) -> list[int]:
    """The bits of each choice of pieces - distance blocks."""
    edges = [bits * i // pieces for i in range(pieces + 1)]
    piece = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(pieces)]
    return [sum(chosen) for chosen in combinations(piece, pieces - distance)]


def pieces_for(n: int, distance: int) -> int:
    """The number of blocks for which n fingerprints are exchanged and compared cheapest."""
    cost = {p: comb(p, distance) * (1 + _COMPARE * n / 2 ** (64 * (p - distance) / p)) for p in range(distance + 1, distance + 8)}
    return min(cost, key=cost.__getitem__)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def spanning_links(values: np.ndarray, distance: int, free: int = (1 << 64) - 1) -> list[tuple[int, int]]:
    """Links of at most ``distance`` bits that connect what such links connect.

    values: different 64-bit integers that agree outside the bits of ``free``.
    """
    places = [b for b in range(64) if free >> b & 1]
    if len(values) > _SPLIT_ABOVE and len(places) > distance:
        out = []
        for part in np.array_split(np.array(places), distance + 1):
            mask = sum(1 << int(b) for b in part)
            key = values & np.uint64(mask)
            order = np.argsort(key, kind="stable")
            cuts = np.flatnonzero(np.diff(key[order])) + 1
            for group in np.split(values[order], cuts):
                if len(group) > 1:
                    out += spanning_links(group, distance, free & ~mask)
        return out
    left, out, queue = values, [], []
    while len(left):
        if not queue:
            queue, left = [left[0]], left[1:]
        here = queue.pop()
        near = np.bitwise_count(left ^ here) <= distance
        if near.any():
            found, left = left[near], left[~near]
            out += [(int(here), int(x)) for x in found]
            queue += list(found)
    return out


def group_links(fp: np.ndarray, cuts: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what close fingerprints connect in each group fp[cuts[i]:cuts[i+1]].

    Small groups are compared at once, member with member at the same offset; groups that
    are large or have more links than they need are walked one by one.
    """
    sizes = np.diff(cuts)
    group = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(fp)) - np.repeat(cuts[:-1], sizes)
    at = np.flatnonzero((sizes > 1)[group] & (sizes <= _SMALL)[group])
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for step in range(1, _SMALL):
        at = at[place[at] + step < sizes[group[at]]]
        if not len(at):
            break
        near = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= distance]
        a.append(near)
        b.append(near + step)
    a, b = np.concatenate(a), np.concatenate(b)
    walked = np.bincount(group[a], minlength=len(sizes)) > 2 * sizes
    slim = ~walked[group[a]]
    more = [p for g in np.flatnonzero(walked | (sizes > _SMALL)) for p in spanning_links(fp[cuts[g] : cuts[g + 1]], distance)]
    return tuple(np.concatenate([fp[x[slim]], np.array([p[i] for p in more], np.uint64)]) for i, x in enumerate((a, b)))


def links(distinct: DataFrame, distance: int = DISTANCE, pieces: int | None = None) -> DataFrame:
    """a, b: close pairs of the different fingerprints in ``fp``, enough of them to
    connect every two that a chain of close pairs connects."""
    pieces = pieces or pieces_for(distinct.count(), distance)
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks(pieces, distance))])
    keyed = distinct.select("fp", F.explode(keys).alias("_k")).select("_k.choice", "_k.key", "fp")
    # ordered by fingerprint too, so that the links of a group do not depend on arrival
    keyed = keyed.repartition("choice", "key").sortWithinPartitions("choice", "key", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, t) for t in (np.int32, np.int64, np.uint64)]

        def found(choice: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            cuts = np.concatenate([[0], np.flatnonzero((choice[1:] != choice[:-1]) | (key[1:] != key[:-1])) + 1, [len(fp)]])
            a, b = group_links(fp, cuts, distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            choice, key, fp = (batch.column(i).to_numpy() for i in range(3))
            choice, key, fp = np.concatenate([rest[0], choice]), np.concatenate([rest[1], key]), np.concatenate([rest[2], fp.view(np.uint64)])
            if not len(fp):
                continue
            same = (choice == choice[-1]) & (key == key[-1])
            last = int(np.argmax(same))  # the last group may go on in the next batch
            rest = [choice[last:], key[last:], fp[last:]]
            if last:
                yield found(choice[:last], key[:last], fp[:last])
        if len(rest[2]):
            yield found(*rest)

    return keyed.mapInArrow(run, "a long, b long")


def components(prints: DataFrame, id_col: str = "doc_id", distance: int = DISTANCE, pieces: int | None = None) -> DataFrame:
    """id, fp and component_id, the smallest id that links lead to, for each row."""
    prints = cut(prints.select(F.col(id_col).alias("_id"), "fp"))
    distinct = cut(prints.groupBy("fp").agg(F.min("_id").alias("_least")))
    reached = connected_components(links(distinct.select("fp"), distance, pieces))
    rooted = distinct.join(reached, F.col("fp") == F.col("node"), "left").select("fp", "_least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("_least").alias("component_id")).withColumnRenamed("root", "_root")
    named = rooted.join(least, F.col("root") == F.col("_root")).select(F.col("fp").alias("_fp"), "component_id")
    return prints.join(named, F.col("fp") == F.col("_fp")).select(F.col("_id").alias(id_col), "fp", "component_id")


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """_id and shingles: the sorted hashes of a text's different word shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for block in blocks(batch.column(1)):
                lower = Block(LOWER[block.data], block.offsets, block.first)
                words, cuts = lower.word_hash(), lower.word_offsets
                for d in range(lower.n_docs):
                    own = words[cuts[d] : cuts[d + 1]]
                    out.append(np.unique(window_hash(own, min(shingle, len(own)))).view(np.int64) if len(own) else np.zeros(0, np.int64))
            sizes = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
            flat = np.concatenate(out) if out else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat))], ["_id", "shingles"])

    return docs.select("_id", "_text").mapInArrow(run, "_id long, shingles array<long>")


def parities(sets: DataFrame) -> DataFrame:
    """_id, n and parity of sets of hashes: for each class of hashes, by their last bits,
    whether the set has an odd number of it. Two sets differ in as many members at least as
    their parities do in bits. A set has two classes for each member, or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, sizes = [], []
            for x in batch.column(1):
                hashes = np.asarray(x.values, np.int64)
                bits = min(max(_BITS[0], 1 << (2 * len(hashes) - 1).bit_length()), _BITS[1])
                out.append(np.packbits(np.bincount(hashes & (bits - 1), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes())
                sizes.append(len(hashes))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(out, pa.binary())], ["_id", "n", "parity"])

    return sets.select("_id", "shingles").mapInArrow(run, "_id long, n long, parity binary")


class Parities:
    """The parities of a group's members, folded to fewer classes as a pair needs it."""

    def __init__(self, column: list[bytes]):
        self.size = np.array([8 * len(p) for p in column])
        self.row = np.zeros(len(column), np.int64)
        self.folded: dict[tuple[int, int], np.ndarray] = {}
        for bits in np.unique(self.size).tolist():
            own = np.flatnonzero(self.size == bits)
            self.row[own] = np.arange(len(own))
            self.folded[bits, bits] = np.frombuffer(b"".join(column[i] for i in own), np.uint64).reshape(len(own), -1)

    def at(self, bits: int, to: int) -> np.ndarray:
        if (bits, to) not in self.folded:
            wide = self.at(bits, 2 * to)
            self.folded[bits, to] = wide[:, : to // 64] ^ wide[:, to // 64 :]
        return self.folded[bits, to]

    def differing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bits that differ between members a[i] and b[i]."""
        out, kinds = np.zeros(len(a), np.int64), self.size[a] << 20 | self.size[b]
        for kind in np.unique(kinds).tolist():
            left, right = kind >> 20, kind & 0xFFFFF
            to = min(left, right)
            x, y = self.at(left, to), self.at(right, to)
            pairs = np.flatnonzero(kinds == kind)
            step = max(1, (4 << 20) // (to // 8))
            for lo in range(0, len(pairs), step):
                some = pairs[lo : lo + step]
                out[some] = np.bitwise_count(x[self.row[a[some]]] ^ y[self.row[b[some]]]).sum(axis=1)
        return out


def forest(a: np.ndarray, b: np.ndarray, root: dict[int, int]) -> np.ndarray:
    """Which of the links (a[i], b[i]), in order, connect what was not connected; root
    remembers what was."""

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = x = root.get(up, up)
        return x

    first = np.sort(np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0, return_index=True)[1]) if len(a) else np.zeros(0, np.int64)
    out = []
    for i, x, y in zip(first.tolist(), a[first].tolist(), b[first].tolist(), strict=True):
        x, y = find(x), find(y)
        if x != y:
            root[y] = x
            out.append(i)
    return np.array(out, np.int64)


def cross_pairs(nodes: DataFrame, distance: int, pieces: int, similarity: float, spanning: bool) -> DataFrame:
    """a, b: pairs of nodes of different labels whose fingerprints are within ``distance``
    bits, but for those whose parities exclude the similarity: all such pairs, or, with
    ``spanning``, enough to connect the labels that they connect, likely ones first.

    nodes: node, fp, label, and n and parity of their shingles. Each pair comes once, from
    the first key that it shares.
    """
    bits = masks(pieces, distance)
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(bits)])
    keyed = nodes.select("node", "fp", "label", "n", "parity", F.explode(keys).alias("_k")).select("_k.choice", "_k.key", "node", "fp", "label", "n", "parity")
    keyed = keyed.repartition("choice", "key").sortWithinPartitions("choice", "key", "node")

    def pairs(group: pa.Table) -> Iterator[pa.RecordBatch]:
        choice, node, label, n = (group.column(c).to_numpy() for c in ("choice", "node", "label", "n"))
        names, sizes = np.unique(label, return_counts=True)
        if len(names) < 2:
            return
        fp = group.column("fp").to_numpy().view(np.uint64)
        parity, root = Parities(group.column("parity").to_pylist()), {}
        largest = label == names[np.argmax(sizes)]
        earlier = [np.uint64(m) for m in bits[: choice[0]]]
        others = np.flatnonzero(~largest)
        step = max(1, 1_000_000 // len(node))
        for at in range(0, len(others), step):
            part = others[at : at + step]
            near = np.bitwise_count(fp[part, None] ^ fp[None]) <= distance
            near &= (label[part, None] != label[None]) & (largest[None] | (node[None] > node[part, None]))
            near &= np.minimum(n[part, None], n[None]) >= similarity * np.maximum(n[part, None], n[None]) - _EPSILON
            i, j = np.nonzero(near)
            i = part[i]
            differ = fp[i] ^ fp[j]
            new = np.ones(len(i), bool)
            for m in earlier:
                new &= (differ & m) != 0
            i, j = i[new], j[new]
            apart = parity.differing(i, j)
            both = n[i] + n[j]
            may = apart <= both * (1 - similarity) / (1 + similarity) + _EPSILON
            i, j, apart, both = i[may], j[may], apart[may], both[may]
            if spanning:
                order = np.argsort(apart / np.maximum(both, 1), kind="stable")
                i, j = i[order], j[order]
                chosen = forest(label[i], label[j], root)
                i, j = i[chosen], j[chosen]
            for lo in range(0, len(i), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(node[i[lo : lo + 100_000]]), pa.array(node[j[lo : lo + 100_000]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            if not len(rest):
                continue
            choice, key = rest.column("choice").to_numpy(), rest.column("key").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero((choice[1:] != choice[:-1]) | (key[1:] != key[:-1])) + 1])
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if hi - lo > 1:
                    yield from pairs(rest.slice(lo, hi - lo))
            rest = rest.slice(cuts[-1])  # the last group may go on in the next batch
        if rest is not None and len(rest) > 1:
            yield from pairs(rest)

    return keyed.mapInArrow(run, "a long, b long")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 2, distance: int = 7, pieces: int | None = None, compare: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of docs without near-duplicates: of each group the row of the smallest id,
    null before all (of rows with that id, the one of the least text hash).

    Near-duplicates have equal texts, or fingerprints within ``distance`` bits and a Jaccard
    similarity of ``similarity`` or more of their ``compare``-word shingles (of two texts
    without words, 1); groups are what chains of them connect. An id says nothing about the
    text: different texts under one id, or without an id, are different documents. The
    fingerprints are of shorter shingles and the distance is wider than in
    ``fingerprints`` and ``links`` as they stand, since fingerprints only propose here:
    an edited word changes fewer of them.

    A few links that connect close fingerprints are verified first. Where that leaves
    texts apart that close fingerprints connect, the likeliest links between the parts are
    verified, as long as that connects more, and at last all pairs between the parts.
    Texts are told apart by 128 bits of hashes.
    """
    require_integers(docs, id_col)
    text = F.col(text_col)
    key = ["_id", "_t", "_u"]
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), own.alias("_id"), F.xxhash64(text).alias("_t"), F.xxhash64(F.lit(1), text).alias("_u"), text.alias("_text"))

    # one node for each different text
    prints = fingerprints(named.select(F.struct(*key).alias("_key"), "_text"), "_key", "_text", shingle)
    texts = prints.groupBy("fp", "_key._t", "_key._u").agg(F.min("_key._id").alias("_id"))
    texts = cut(texts.withColumn("node", F.monotonically_increasing_id()))
    firsts = cut(texts.groupBy("fp").agg(F.min("node").alias("first")))
    of = lambda c: firsts.select(F.col("fp").alias(f"_f{c}"), F.col("first").alias(f"_{c}"))
    pieces = pieces or pieces_for(firsts.count(), distance)
    found = links(firsts.select("fp"), distance, pieces).distinct().join(of("a"), F.col("a") == F.col("_fa")).join(of("b"), F.col("b") == F.col("_fb"))
    same = texts.join(of("a"), F.col("fp") == F.col("_fa")).filter("node != _a").select("_a", F.col("node").alias("_b"))
    proposed = cut(found.select("_a", "_b").union(same).toDF("a", "b"))

    nodes = proposed.select(F.col("a").alias("_node")).union(proposed.select("b")).distinct()
    nodes = texts.join(nodes, F.col("node") == F.col("_node")).select(*key, "node", "fp")
    shown = named.select(*key, "_text").join(nodes.select(*key, "node").hint("merge"), key).select(F.col("node").alias("_id"), "_text")
    sets = cut(shingle_sets(shown, compare).groupBy("_id").agg(F.max("shingles").alias("shingles")))

    def similar(pairs: DataFrame) -> DataFrame:
        side = lambda c: sets.select(F.col("_id").alias(f"_n{c}"), F.col("shingles").alias(f"_s{c}"))
        both = pairs.join(side("a"), F.col("a") == F.col("_na")).join(side("b"), F.col("b") == F.col("_nb"))
        common = F.size(F.array_intersect("_sa", "_sb"))
        return both.filter(common >= similarity * (F.size("_sa") + F.size("_sb") - common)).select("a", "b")

    def labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        of = lambda c: labels.select(F.col("node").alias(f"_n{c}"), F.col("label").alias(f"_l{c}"))
        out = pairs.join(of("a"), F.col("a") == F.col("_na")).join(of("b"), F.col("b") == F.col("_nb"))
        return out.filter("_la != _lb").select("_la", "_lb")

    def name(nodes: DataFrame, edges: DataFrame, at: str) -> DataFrame:
        roots = connected_components(edges).withColumnRenamed("node", "_n")
        return nodes.join(roots, F.col(at) == F.col("_n"), "left").withColumn("label", F.coalesce("root", at)).drop("_n", "root")

    labels = cut(name(nodes, similar(proposed), "node"))
    sketches, spanning, apart = None, True, proposed
    while True:
        # a label is a node of that label, so pairs of labels are labelled like pairs of nodes
        apart = cut(labelled(apart, labels).select(F.least("_la", "_lb").alias("a"), F.greatest("_la", "_lb").alias("b")).distinct())
        if apart.isEmpty():
            break
        if sketches is None:
            sketches = cut(parities(sets)).withColumnRenamed("_id", "_n")
        ends = apart.select(F.col("a").alias("_l")).union(apart.select("b"))
        open_ = labels.join(ends, F.col("label") == F.col("_l"), "left_semi").join(sketches, F.col("node") == F.col("_n"))
        more = cut(labelled(similar(cross_pairs(open_, distance, pieces, similarity, spanning)), labels).toDF("a", "b"))
        merged = not more.isEmpty()
        if merged:
            labels = cut(name(labels, more, "label"))
        if not spanning:
            break  # all pairs between the labels have been verified
        spanning = merged

    grouped = texts.join(labels.select(F.col("node").alias("_n"), "label"), F.col("node") == F.col("_n"), "left")
    first = grouped.groupBy(F.coalesce("label", "node").alias("label")).agg(F.min(F.struct(*key)).alias("_key")).select("_key.*")
    kept = named.join(first.hint("merge"), key)
    whole = F.xxhash64(*[F.col("_row").getField(c) for c, kind in docs.dtypes if "map<" not in kind])
    order = Window.partitionBy(*key).orderBy(whole)
    return kept.withColumn("_n", F.row_number().over(order)).filter("_n = 1").select("_row.*")


def hex_digits(fp: str = "fp") -> Column:
    """A fingerprint as 16 lower-case digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
