"""Long repeats across a corpus: finding candidate places and settling windows.

Both repeat operators need every run of ``window`` units (words or bytes) that
occurs more than once, without moving a copy of the text for each position. A window
is represented by its anchor: of the ``gram``-unit strings inside it, the one of the
least hash. Equal windows have equal anchors at equal offsets, so a corpus needs one
suffix for each anchor (about two in ``window - gram`` positions), and only anchors
whose gram occurs twice go on with their text around them.

``candidates``  docs -> anchors -> buckets of equal grams -> anchors with company.
``settle``      suffixes of one bucket in order, with common prefixes -> windows
                that occur again.
``gather``      covered runs of every document.

A group of copies meets its own kind inside a task first: of equal stretches, whose
bytes are compared, only the first goes on, the others are known to be covered. A gram
with more than ``HOT`` different stretches is partitioned by whole windows instead of by
its own units: a task that alone has its share of them (``HOT`` divided by the number of
shuffle partitions) sends them past the bucket and tells the bucket so; equal windows
meet inside the task first again. So no task holds more than about ``HOT`` places of a
gram, and no group of equal keys grows with the copies in the corpus. Hashes only
propose; whatever leads to a removal compares bytes or words.

Buckets hold about ``BUCKET_BYTES`` of text each, whatever the size of the corpus.

Rows are told apart by id and a hash of the text; rows that repeat both are one place
for the order and two places for the count. Ids are integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ids import require_integers
from .words import mix, pair_hash, run_hashes

HOT = 20_000
BUCKET_BYTES = 8 << 20
_FLUSH = 3_000_000
_FLUSH_BYTES = 64 << 20
_WITNESS = 0xFFFF
_PLACE = (1 << 28) - 1
ANCHOR, HOT_ANCHOR, COVER = 0, 1, 2
#: An anchor (its place, the windows before and around it) or a covered run (pos to key).
RECORD = np.dtype([("key", "<u8"), ("pos", "<u4"), ("back", "<u2"), ("span", "<u2"), ("kind", "u1")])
BUCKETED = "bucket int, id long, th long, rows binary, body binary"
PLACED = "id long, th long, body binary"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have, out = 1, x
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def find_anchors(units: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> dict[str, np.ndarray]:
    """Anchors of all windows of some documents: doc, key, pos, back, span, hash.

    pos is the anchor's place in its document; the windows that have it start from
    pos - back on, span + 1 of them; low and high are the first unit of all that these
    windows cover and the end, counted from the first document on; hash is of these units.
    """
    n = len(units)
    empty = {k: np.zeros(0, np.int64) for k in ("doc", "pos", "back", "span", "low", "high")} | {k: np.zeros(0, np.uint64) for k in ("key", "hash")}
    if n < window:
        return empty
    grams, windows = run_hashes(units, gram, window)
    ranked = (grams & np.uint64(~_PLACE & (1 << 64) - 1)) | (np.arange(len(grams), dtype=np.uint64) & np.uint64(_PLACE))
    least = sliding_min(ranked, window - gram + 1)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    start = np.flatnonzero(np.arange(window, n + 1) <= ends[: n - window + 1])
    if not len(start):
        return empty
    at = start + (((least[start] & np.uint64(_PLACE)).astype(np.int64) - start) & _PLACE)
    change = np.flatnonzero(at[1:] != at[:-1])
    low, high = start[np.concatenate([[0], change + 1])], start[np.concatenate([change, [len(start) - 1]])]
    at = at[np.concatenate([[0], change + 1])]
    doc = np.searchsorted(offsets, at, "right") - 1
    whole = mix(pair_hash(windows[low], windows[high]) + (high - low).astype(np.uint64))
    return {"doc": doc, "key": grams[at], "pos": at - offsets[doc], "back": at - low, "span": high - low, "low": low, "high": high + window, "hash": whole}


def merge_runs(group: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The union of runs [start, end) within each group, in order of group and start."""
    if not len(group):
        return group, start, end
    order = np.lexsort((start, group))
    group, start, end = group[order], start[order], end[order]
    shift = group.astype(np.int64) * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + shift)
    new = np.concatenate([[True], start[1:] + shift[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:] - 1, [len(group) - 1]])
    return group[first], start[first], reach[last] - shift[first]


def binary(sizes: np.ndarray, data: bytes) -> pa.Array:
    """Consecutive slices of data."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def by_document(ids: np.ndarray, ths: np.ndarray, records: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """One row of records for each document."""
    order = np.lexsort((ths, ids))
    ids, ths, records = ids[order], ths[order], records[order]
    first = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (ths[1:] != ths[:-1])])) if len(ids) else np.zeros(0, np.int64)
    sizes = np.diff(np.concatenate([first, [len(ids)]])) * RECORD.itemsize
    return ids[first], ths[first], binary(sizes, records.tobytes())


def covers(ids: np.ndarray, ths: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Covered runs as one row of records for each document."""
    pairs, group = np.unique(np.stack([ids, ths], axis=1), axis=0, return_inverse=True) if len(ids) else (np.zeros((0, 2), np.int64), np.zeros(0, np.int64))
    group, start, end = merge_runs(group.reshape(-1), start, end)
    records = np.zeros(len(group), RECORD)
    records["key"], records["pos"], records["kind"] = end, start, COVER
    return by_document(pairs[group, 0], pairs[group, 1], records)


def pass_on(ids: np.ndarray, ths: np.ndarray, bodies: pa.Array, buckets: int) -> pa.RecordBatch:
    """Rows of covered runs for a later stage, dealt out by document."""
    bucket = (mix(ids.astype(np.uint64) ^ ths.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(ids), pa.array(ths), pa.nulls(len(ids), pa.binary()), bodies], ["bucket", "id", "th", "rows", "body"])


def identified(docs: DataFrame, id_col: str, text_col: str, carry: bool = False) -> DataFrame:
    """id (null: the least long), th, text (null: empty) and nil (the id is null); with
    the whole row if asked."""
    require_integers(docs, id_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rest = [F.struct(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"), F.col(text_col).isNull().alias("null")).alias("rest")] if carry else []
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"), F.col(id_col).isNull().alias("nil"), *rest)


def n_buckets(rows: DataFrame) -> int:
    """Buckets of BUCKET_BYTES of text, and some for each partition at least."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(8 * n_partitions(rows), -(-size // BUCKET_BYTES))


def n_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def pack_anchors(key: np.ndarray, pos: np.ndarray, back: np.ndarray, span: np.ndarray, doc: np.ndarray, ids: np.ndarray, ths: np.ndarray) -> bytes:
    """Anchors column by column, in order of their documents, which are listed once."""
    order = np.lexsort((pos, doc))
    docs, sizes = np.unique(doc, return_counts=True)
    head = np.array([len(docs), len(key)], "<u4")
    columns = (ids[docs], ths[docs], sizes.astype("<u4"), key[order], pos[order].astype("<u4"), back[order].astype("<u2"), span[order].astype("<u2"))
    return head.tobytes() + b"".join(c.tobytes() for c in columns)


def unpack_anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Records, ids and ths of packed anchors."""
    docs, n = (int(x) for x in np.frombuffer(data, "<u4", 2))
    out, at = [], 8
    for kind, count in (("<i8", docs), ("<i8", docs), ("<u4", docs), ("<u8", n), ("<u4", n), ("<u2", n), ("<u2", n)):
        out.append(np.frombuffer(data, kind, count, at))
        at += out[-1].nbytes
    ids, ths, sizes, key, pos, back, span = out
    body = np.zeros(n, RECORD)
    body["key"], body["pos"], body["back"], body["span"] = key, pos, back, span
    return body, np.repeat(ids, sizes), np.repeat(ths, sizes)


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | list[tuple[bytes, bytes]]]:
    """Of rows sorted by bucket: those of a document as they come, in the form of
    PLACED, and the (rows, body) of each bucket as a list, so that a task holds one."""
    here, held = None, []
    for batch in batches:
        packed = pa.compute.is_valid(batch.column(3))
        done = batch.filter(pa.compute.invert(packed))
        if done.num_rows:
            yield pa.RecordBatch.from_arrays([done.column(1), done.column(2), done.column(4)], ["id", "th", "body"])
        packed = batch.filter(packed)
        for bucket, rows, body in zip(packed.column(0).to_pylist(), packed.column(3), packed.column(4), strict=True):
            if bucket != here and held:
                yield held
                held = []
            here = bucket
            held.append((rows.as_py(), body.as_py()))
    if held:
        yield held


def sift(a: dict[str, np.ndarray], ids: np.ndarray, ths: np.ndarray, raw: bytes, window: int, first_stays: bool, buckets: int, share: int) -> Iterator[pa.RecordBatch]:
    """Rows of BUCKETED of the anchors of some documents. Equal stretches, told by their
    bytes in raw (from a["lo"] to a["hi"]), are covered but for the first. Of a gram with
    over ``share`` different stretches the anchors go past the buckets as hot ones, and a
    witness of that goes to the gram's bucket."""
    order = np.argsort(a["hash"])
    same = a["hash"][order][1:] == a["hash"][order][:-1]
    many = np.zeros(len(order), bool)
    many[order[1:][same]] = True
    many[order[:-1][same]] = True
    twin = np.flatnonzero(many)
    doc, pos = a["doc"], a["pos"]
    twin = twin[np.lexsort((ths[doc[twin]], pos[twin], ids[doc[twin]], a["hash"][twin]))]
    h = a["hash"][twin]
    head = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
    group = np.cumsum(head) - 1
    lead = twin[np.flatnonzero(head)[group]] if len(h) else twin
    # hashes propose, bytes decide
    equal = np.zeros(len(twin), bool)
    for at in range(0, len(twin), 50_000):
        part, first = twin[at : at + 50_000], lead[at : at + 50_000]
        spans = zip(*(x.tolist() for x in (a["lo"][part], a["hi"][part], a["lo"][first], a["hi"][first])), strict=True)
        equal[at : at + 50_000] = [raw[p:q] == raw[r:s] for p, q, r, s in spans]
    equal &= ~head
    if first_stays:
        hit = equal & ((ids[doc[twin]] != ids[doc[lead]]) | (pos[twin] != pos[lead]))
        gone = hit | (equal & (ths[doc[twin]] == ths[doc[lead]]))
    else:
        hit = equal | (head & (np.bincount(group, equal, len(h))[group] > 0))
        gone = equal
    c = twin[hit]
    if len(c):
        low = pos[c] - a["back"][c]
        yield pass_on(*covers(ids[doc[c]], ths[doc[c]], low, low + a["span"][c] + window), buckets)
    stay = np.ones(len(many), bool)
    stay[twin[gone]] = False
    go = np.flatnonzero(stay)
    grams, gram, count = np.unique(a["key"][go], return_inverse=True, return_counts=True)
    hot = count[gram.reshape(-1)] > share if len(go) else np.zeros(0, bool)
    key, back, span = a["key"], a["back"].astype(np.int64), a["span"].astype(np.int64)
    sure = go[hot]
    for at in range(0, len(sure), 100_000):
        g = sure[at : at + 100_000]
        records = np.zeros(len(g), RECORD)
        records["key"], records["pos"], records["back"], records["span"], records["kind"] = key[g], pos[g], back[g], span[g], HOT_ANCHOR
        yield pass_on(*by_document(ids[doc[g]], ths[doc[g]], records), buckets)
    witness = grams[count > share]
    go = go[~hot]
    keys, place = np.concatenate([key[go], witness]), np.concatenate([pos[go], np.zeros(len(witness), pos.dtype)])
    back = np.concatenate([back[go], np.zeros(len(witness), np.int64)])
    span = np.concatenate([span[go], np.full(len(witness), _WITNESS)])
    owner = np.concatenate([doc[go], np.zeros(len(witness), doc.dtype)])
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.concatenate([np.flatnonzero(np.diff(bucket[order], prepend=-1)), [len(order)]])
    squeeze = zstandard.ZstdCompressor(level=1)
    out = []
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        g = order[lo:hi]
        out.append(squeeze.compress(pack_anchors(keys[g], place[g], back[g], span[g], owner[g], ids, ths)))
    n = len(out)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(bucket[order[cuts[:-1]]].astype(np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array([b""] * n, pa.binary()), pa.array(out, pa.binary())], ["bucket", "id", "th", "rows", "body"])


def with_company(body: np.ndarray, limit: int) -> np.ndarray:
    """Places of the anchors of a bucket whose gram has another place, by gram; their
    kind is set. Witnesses make their gram hot and are left out."""
    order = np.argsort(body["key"], kind="stable")
    key = body["key"][order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    group = np.cumsum(new) - 1
    witness = body["span"][order] == _WITNESS
    size = np.bincount(group) + limit * np.bincount(group, witness).astype(np.int64)
    good = (size[group] > 1) & ~witness
    pick = order[good]
    body["kind"][pick] = np.where(size[group][good] > limit, HOT_ANCHOR, ANCHOR)
    return pick


def candidates(rows: DataFrame, units: Callable, window: int, gram: int, first_stays: bool, buckets: int) -> DataFrame:
    """id, th, body: anchors with company and covered runs, in rows of RECORD.

    units: gives (first row, unit values, offsets, bytes, place of each unit in the
    bytes) of each block of a text column. first_stays: the first of equal stretches is
    not covered by the others.
    """
    hot = HOT
    share = max(2, hot // n_partitions(rows))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, raw, ids, ths, held, n_docs, size = [], [], [], [], 0, 0, 0

        def all_of() -> Iterator[pa.RecordBatch]:
            whole = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
            return sift(whole, np.concatenate(ids), np.concatenate(ths), b"".join(raw), window, first_stays, buckets, share)

        for batch in batches:
            for first, values, offsets, text, at in units(batch.column(2)):
                found = find_anchors(values, offsets, window, gram)
                found["doc"] = found["doc"] + first + n_docs
                found["lo"], found["hi"] = (at[found.pop(k)] + size for k in ("low", "high"))
                parts.append(found)
                held += len(found["doc"])
                raw.append(text.tobytes())
                size += len(raw[-1])
            ids.append(batch.column(0).to_numpy())
            ths.append(batch.column(1).to_numpy())
            n_docs += batch.num_rows
            if held > _FLUSH or size > _FLUSH_BYTES:
                yield from all_of()
                parts, raw, ids, ths, held, n_docs, size = [], [], [], [], 0, 0, 0
        if held:
            yield from all_of()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in by_bucket(batches):
            if isinstance(bucket, pa.RecordBatch):
                yield bucket
                continue
            expand = zstandard.ZstdDecompressor()
            body, ids, ths = (np.concatenate(x) for x in zip(*(unpack_anchors(expand.decompress(body)) for _, body in bucket), strict=True))
            pick = with_company(body, hot)
            for at in range(0, len(pick), 100_000):
                part = pick[at : at + 100_000]
                i, t, b = by_document(ids[part], ths[part], body[part])
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(t), b], ["id", "th", "body"])

    return rows.mapInArrow(place, BUCKETED).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, PLACED)


def gather(placed: DataFrame) -> DataFrame:
    """id, th and the bodies of each document; their number is bounded by its length."""
    return placed.groupBy("id", "th").agg(F.collect_list("body").alias("bodies")).withColumnsRenamed({"id": "_id", "th": "_th"})


class HotWindows:
    """The windows of hot anchors of a task: equal ones meet here first, by their text.

    first_stays: the earliest of equal windows is not covered, and goes on; else all of
    several equal ones are covered and one goes on.
    """

    def __init__(self, window: int, first_stays: bool):
        self.window, self.first_stays = window, first_stays
        self.kept: dict[tuple[bytes, int], list] = {}
        self.found: list[tuple[int, int, int]] = []

    def add(self, text: bytes, doc: int, th: int, start: int, head: tuple) -> int:
        """The bytes held more than before."""
        mine = [doc, th, start, head, False]
        known = self.kept.get((text, 0))
        if known is None:
            self.kept[text, 0] = mine
            return len(text) + 100
        if not self.first_stays:
            self.found.append((doc, th, start))
            if not known[4]:
                known[4] = True
                self.found.append(tuple(known[:3]))
        elif (doc, start) == (known[0], known[2]):
            if th != known[1]:  # another row of this id, at the same place
                self.kept[text, th] = mine
        elif (doc, start) < (known[0], known[2]):
            self.found.append(tuple(known[:3]))
            self.kept[text, 0] = mine
        else:
            self.found.append((doc, th, start))
        return 24

    def rows(self) -> Iterator[tuple[bytes, tuple]]:
        """text and head of each window that goes on."""
        return ((text, v[3]) for (text, _), v in self.kept.items())

    def covered(self, buckets: int) -> Iterator[pa.RecordBatch]:
        if self.found:
            ids, ths, start = np.array(self.found, np.int64).T
            yield pass_on(*covers(ids, ths, start, start + self.window), buckets)


def with_text(rows: DataFrame, placed: DataFrame, how: str) -> DataFrame:
    """rows with the bodies of their document. All columns of rows go along, so that both
    joins of an operator read the same exchange."""
    found = gather(placed)
    return rows.join(found.hint("merge"), (F.col("id") == F.col("_id")) & (F.col("th") == F.col("_th")), how).drop("_id", "_th")


def records_of(bodies: pa.Scalar) -> np.ndarray:
    return np.concatenate([np.frombuffer(b.as_py(), RECORD) for b in bodies.values]) if bodies.is_valid and len(bodies.values) else np.zeros(0, RECORD)


def classes(lcp: np.ndarray, depth: int) -> np.ndarray:
    """Of leaves in order, the number of the subtree below ``depth`` each lies in."""
    return np.cumsum(lcp < depth)


def settle(order: np.ndarray, lcp: np.ndarray, left_order: np.ndarray, left_lcp: np.ndarray, ids: np.ndarray, ths: np.ndarray, pos: np.ndarray, back: np.ndarray, span: np.ndarray, window: int, first_stays: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, ths, starts, ends of runs covered by windows that occur again.

    order, lcp: the suffixes from each anchor on, sorted, and the units that each has
    in common with the one before. left_order, left_lcp: the same for the units before
    the anchor, read backwards. A window with ``b`` units before its anchor equals
    another if both lie in the same subtree of depth window - b on the right and of
    depth b on the left.
    """
    n = len(order)
    right_rank, left_rank = np.empty(n, np.int64), np.empty(n, np.int64)
    right_rank[order], left_rank[left_order] = np.arange(n), np.arange(n)
    by_place = np.lexsort((ths, pos, ids))
    right_rank, left_rank = right_rank[by_place], left_rank[by_place]
    ids, ths, pos, back, span = ids[by_place], ths[by_place], pos[by_place], back[by_place], span[by_place]
    low, high = back - span, back  # units before the anchor, fewest and most
    who, start = [], []
    for b in range(int(high.max()) + 1 if n else 0):
        have = np.flatnonzero((low <= b) & (b <= high))
        if len(have) < 2:
            continue
        right, left = classes(lcp, window - b)[right_rank[have]], classes(left_lcp, b)[left_rank[have]]
        key = right * (n + 1) + left
        o = np.argsort(key, kind="stable")
        k = key[o]
        new = np.concatenate([[True], k[1:] != k[:-1]])
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        if first_stays:
            me, lead = have[o], have[o[head]]
            hit = (ids[me] != ids[lead]) | (pos[me] != pos[lead])
        else:
            hit = ~new
            hit[:-1] |= ~new[1:]
        found = have[o[hit]]
        who.append(found)
        start.append(pos[found] - b)
    if not who:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    who, start = np.concatenate(who), np.concatenate(start)
    who, start, end = merge_runs(who, start, start + window)
    return ids[who], ths[who], start, end
