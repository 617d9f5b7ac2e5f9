"""Binary token files: id arrays with Elias-Fano coded document boundaries.

A file holds the ids of consecutive documents in one array, 16 bits each where the
vocabulary allows it, else 32, then the Elias-Fano code of the boundaries (one more than
documents), that of the document ids, and a footer of fixed size with their places. A
reader finds any document by two selects, without a table of 64-bit offsets.

``write`` sorts documents by id over all tasks (ranges of id, then of a hash of the text,
so rows that share an id are spread too); every task writes its range as files of about
``shard_ids`` ids, streaming the array out, so it holds a batch and one length a document.
Files have names of their own for each attempt. Only what the successful attempts report
becomes part of the manifest, which gets the counts before each file by a prefix sum and is
put in place last: lost executors and repeated attempts leave no trace in a read. The data
source is named ``token_shards``.

Paths are those that pyarrow opens on all machines: shared folders, or s3, gs and hdfs
addresses.

Defined cases: null text is an empty one, which has the end id alone (no ids, if there is no
end id); null document ids come first; rows of one id are ordered by hash and text; ids at
the ends of 64 bits are kept; an empty table gives a manifest without files and an empty
read; a folder that has a manifest is replaced only with ``overwrite``.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from . import eliasfano
from .ids import require_integers
from .units import Units, load_library, lowered, words

SHARD_IDS = 1 << 25
SHARD_DOCS = 1 << 22
READ_IDS = 1 << 20
MANIFEST = "manifest.json"
_MAGIC = b"TOKSHRD1"
#: Bytes of an id, ids, documents with a null id, documents, bytes of both codes.
_FOOT = struct.Struct("<B7xQQQQQ8s")
_SIGN = np.uint64(1 << 63)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)


@dataclass
class Shard(InputPartition):
    file: str
    docs: int
    ids: int
    start: int = 0


@dataclass
class Written(WriterCommitMessage):
    part: int
    shards: list[Shard] = field(default_factory=list)


class _File:
    """One file while it is written."""

    def __init__(self, fs: pafs.FileSystem, root: str, name: str, width: int):
        self.name, self.kind, self.out = name, f"<u{width}", fs.open_output_stream(f"{root}/{name}")
        self.width, self.n_ids, self.doc_ids, self.lengths = width, 0, [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> (8 * self.width):
            raise ValueError(f"an id needs more than {self.width} bytes")
        self.out.write(ids.astype(self.kind, copy=False).tobytes())
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.n_ids += len(ids)

    def close(self) -> Shard:
        ends = np.zeros(len(self.lengths) + 1, np.uint64)
        np.cumsum(np.array(self.lengths, np.uint64), out=ends[1:])
        known = np.array([i for i in self.doc_ids if i is not None], np.int64)
        bounds, names = eliasfano.build(ends), eliasfano.build(known.view(np.uint64) ^ _SIGN)  # keeps the order of signed ids
        self.out.write(bounds + names)
        self.out.write(_FOOT.pack(self.width, self.n_ids, len(self.doc_ids) - len(known), len(self.doc_ids), len(bounds), len(names), _MAGIC))
        self.out.close()
        return Shard(self.name, len(self.lengths), self.n_ids)


class TokenFile:
    """A file's documents by position: ``bounds`` and ``names`` are its codes."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.source = fs.open_input_file(path)
        size = self.source.size()
        self.width, self.n_ids, self.nulls, self.docs, n_bounds, n_names, magic = _FOOT.unpack(self.source.read_at(_FOOT.size, size - _FOOT.size))
        if magic != _MAGIC:
            raise ValueError(f"{path} is no token file")
        codes = self.source.read_at(n_bounds + n_names, self.n_ids * self.width)
        self.bounds = eliasfano.EliasFano(codes)
        self.names = eliasfano.EliasFano(memoryview(codes)[n_bounds:])

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """The ids from one place of the array to before another."""
        return np.frombuffer(self.source.read_at((hi - lo) * self.width, lo * self.width), f"<u{self.width}")

    def document(self, at: int) -> np.ndarray:
        lo, hi = self.bounds.select(at, at + 2)
        return self.ids(int(lo), int(hi))

    def doc_ids(self, lo: int, hi: int) -> list[int | None]:
        known = self.names.select(max(0, lo - self.nulls), max(0, hi - self.nulls))
        return [None] * (hi - lo - len(known)) + (known ^ _SIGN).view(np.int64).tolist()


def _normalizers(spec: dict | None) -> list[dict]:
    return [] if spec is None else spec.get("normalizers", [spec])


class _Encoder:
    """Ids of texts, from a tokenizer file of the tokenizers library."""

    JOINED = 256

    def __init__(self, path: str):
        self.library = load_library(path)
        spec = json.loads(self.library.to_str())
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        lower = any(n["type"] == "Lowercase" for n in _normalizers(spec["normalizer"]))
        self.units = Units(self._encoded, (lambda text: words(lowered(text))) if lower else words)
        suffix, self.ends = spec["model"].get("end_of_word_suffix"), np.zeros(self.library.get_vocab_size(), bool)
        for token, i in self.library.get_vocab(with_added_tokens=False).items():
            self.ends[i] = bool(suffix) and token.endswith(suffix)

    def _encoded(self, new: list[str]) -> list[bytes]:
        """Words of letters alone, which end with one token that ends a word, are given to
        the library some hundred at a time."""
        letters = [u for u in new if u.isalpha()] if self.ends.any() else []
        rest = list(set(new) - set(letters))
        known = dict(zip(letters, self._together(letters), strict=True)) | dict(zip(rest, self._single(rest), strict=True))
        return [known[u] for u in new]

    def _single(self, units: list[str]) -> list[bytes]:
        return [np.array(e.ids, f"<u{self.width}").tobytes() for e in self.library.encode_batch_fast(units, add_special_tokens=False)]

    def _together(self, units: list[str]) -> list[bytes]:
        if len(units) < 2:
            return self._single(units)
        strings = [" ".join(units[k : k + self.JOINED]) for k in range(0, len(units), self.JOINED)]
        found = [e.ids for e in self.library.encode_batch_fast(strings, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), f"<u{self.width}", sum(map(len, found)))
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(units):  # some letter is several characters in lower case
            half = len(units) // 2
            return self._together(units[:half]) + self._together(units[half:])
        data = ids.tobytes()
        return [data[lo:hi] for lo, hi in pairwise([0, *(self.width * ends).tolist()])]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(b"".join(parts), f"<u{self.width}") for parts in self.units.of(texts)]


_encoders: dict[str, _Encoder] = {}


def _encoder(path: str) -> _Encoder:
    """One encoder a Python worker, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = _Encoder(path)
    return _encoders[path]


class TokenShards(DataSource):
    """``token_shards``. Options of a write: tokenizer (a file; else the second column
    holds little-endian 32-bit ids), end_id, width, shard_ids. The frame has an id and a
    text, in the order they are to be kept."""

    @classmethod
    def name(cls) -> str:
        return "token_shards"

    def schema(self) -> str:
        return "doc_id bigint, start bigint, n_tokens bigint, ids binary"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options), overwrite)


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.tokenizer, self.run = options["path"], options.get("tokenizer"), uuid.uuid4().hex
        self.end_id = int(options["end_id"]) if options.get("end_id") else None
        self.width, self.shard_ids, self.overwrite = int(options.get("width", 4)), int(options.get("shard_ids", SHARD_IDS)), overwrite
        fs, root = _open(self.path)
        if not overwrite and fs.get_file_info(f"{root}/{MANIFEST}").type == pafs.FileType.File:
            raise FileExistsError(self.path)
        fs.create_dir(root, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        fs, root = _open(self.path)
        encoder = _encoder(self.tokenizer) if self.tokenizer else None
        done, file = Written(task.partitionId()), None
        end = [] if self.end_id is None else [self.end_id]
        for batch in iterator:
            for at in range(0, batch.num_rows, 500):  # bounds the ids in memory
                doc_ids, texts = (c.to_pylist() for c in batch.slice(at, 500).columns)
                found = encoder.ids([t or "" for t in texts]) if encoder else [np.frombuffer(t or b"", "<u4") for t in texts]
                for doc_id, ids in zip(doc_ids, found, strict=True):
                    if file is None:
                        file = _File(fs, root, f"{self.run}-{done.part:06d}-{len(done.shards):06d}-{task.taskAttemptId()}.tok", encoder.width if encoder else self.width)
                    file.add(doc_id, np.concatenate([ids, np.array(end, ids.dtype)]))
                    if file.n_ids >= self.shard_ids or len(file.lengths) >= SHARD_DOCS:
                        done.shards.append(file.close())
                        file = None
        if file is not None:
            done.shards.append(file.close())
        return done

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = _open(self.path)
        shards, start = [], 0
        for m in sorted((m for m in messages if m), key=lambda m: m.part):
            for s in m.shards:
                shards.append({"file": s.file, "docs": s.docs, "ids": s.ids, "start": start})
                start += s.ids
        with fs.open_output_stream(f"{root}/{self.run}.json") as out:
            out.write(json.dumps(shards).encode())
        fs.move(f"{root}/{self.run}.json", f"{root}/{MANIFEST}")
        self._drop(fs, root, {s["file"] for s in shards})

    def abort(self, messages: list) -> None:
        fs, root = _open(self.path)
        self._drop(fs, root, None)

    def _drop(self, fs: pafs.FileSystem, root: str, keep: set[str] | None) -> None:
        """Files of failed attempts; after a commit those of an earlier write, too."""
        for info in fs.get_file_info(pafs.FileSelector(root)):
            own = info.base_name.startswith(self.run)
            if info.base_name.endswith(".tok") and (own if keep is None else info.base_name not in keep):
                fs.delete_file(info.path)


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Shard]:
        fs, root = _open(self.path)
        with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
            return [Shard(**s) for s in json.loads(f.read())] or [Shard("", 0, 0)]

    def read(self, shard: Shard) -> Iterator[pa.RecordBatch]:
        if not shard.docs:
            return
        fs, root = _open(self.path)
        file, at = TokenFile(fs, f"{root}/{shard.file}"), 0
        while at < file.docs:
            to = min(file.docs, at + 1000)
            bounds = file.bounds.select(at, to + 1).astype(np.int64)
            to = at + max(1, int(np.searchsorted(bounds, bounds[0] + READ_IDS, "right")) - 1)
            bounds = bounds[: to - at + 1]
            ids = file.ids(int(bounds[0]), int(bounds[-1])).astype("<u4")
            cuts = (4 * (bounds - bounds[0])).astype(np.int64)
            arrays = [pa.array(file.doc_ids(at, to), pa.int64()), pa.array(bounds[:-1] + shard.start), pa.array(np.diff(bounds))]
            binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), to - at, [None, pa.py_buffer(cuts), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([*arrays, binary.cast(pa.binary())], ["doc_id", "start", "n_tokens", "ids"])
            at = to


def write(docs: DataFrame, path: str, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = None, overwrite: bool = False, shard_ids: int = SHARD_IDS, width: int = 4) -> None:
    """docs as token files in ascending order of id.

    tokenizer: a vocabulary file of the tokenizers library whose words white space ends,
    on every machine; without it text_col holds binary ids, little-endian and 32 bits
    wide, of which ``width`` bytes are kept.
    """
    require_integers(docs, id_col)
    docs.sparkSession.dataSource.register(TokenShards)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.col(f"`{text_col}`").alias("t"))
    sorted_rows = rows.repartitionByRange(F.col("i"), F.xxhash64("t")).sortWithinPartitions("i", F.xxhash64("t"), "t")
    options = {"tokenizer": tokenizer, "end_id": end_id, "shard_ids": shard_ids, "width": width}
    sorted_rows.write.format("token_shards").mode("overwrite" if overwrite else "append").options(**{k: v for k, v in options.items() if v is not None}).save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids (binary, 32 bits
    each) of what ``write`` left, one task a file."""
    spark.dataSource.register(TokenShards)
    return spark.read.format("token_shards").load(path)
