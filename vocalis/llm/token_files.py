"""Token ids in files of independent zstandard frames with a seek table.

A file is a run of zstandard frames, one per document, each with the document's ids as little-endian
unsigned 32-bit integers; a skippable frame with the document keys; and a trailing skippable frame with
the seek table: compressed size, raw size and the checksum of every frame, the number of frames, a
descriptor and a magic number. Any zstandard reader can decompress such a file as a whole; ``Reader``
seeks and decompresses only the documents asked for, and checks their checksums.

Files are named by the attempt that wrote them; the manifest, a table that Spark commits, lists those that
count. A lost or repeated task leaves a file that nobody reads.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from vocalis.llm import common
from vocalis.session import workspace

END = 0
LEVEL = 3
SKIPPABLE_TABLE, SKIPPABLE_KEYS, FOOTER = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
#: The descriptor's top bit: entries hold checksums.
CHECKSUMS = 0x80
ENTRY = struct.Struct("<III")
#: Chunks remembered per worker; beyond that half of them are dropped.
CACHE = 800_000
#: Characters of a chunk that is not remembered, so texts without spaces do not stay in a worker.
LONG = 64
#: Documents read back at once.
READ_ROWS = 512
#: Where a text may be cut before it is encoded: after a non-space, before one space and a non-space.
CUT = re.compile(r"(?<=\S)(?= \S)")


@lru_cache(maxsize=2)
def load(path: str) -> tuple[Tokenizer, list[str], np.ndarray]:
    """The tokenizer, the strings it looks for before merging, and the UTF-8 length of every id."""
    tokenizer = Tokenizer.from_file(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    lengths = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
    for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
        lengths[i] = len(token)  # a byte-level vocabulary writes every byte as one character
    return tokenizer, special, lengths


class Encoder:
    """Ids of whole texts as the tokenizer gives them without added tokens, as little-endian uint32 bytes.

    The byte-level splitter never puts a space behind another character of the same pre-token, so where a
    space stands between two non-spaces a pre-token starts, whatever follows. A text is cut there, and the
    chunks are encoded once each and remembered. Texts with special strings go through the library whole.
    """

    def __init__(self, path: str):
        self.tokenizer, self.special, self.lengths = load(path)
        self.after_space: dict[str, bytes] = {}  # by what follows the one space before a chunk
        self.other: dict[str, bytes] = {}  # starts of texts, and chunks with white space at an end

    def encode(self, texts: list[str]) -> list[bytes]:
        for known in (self.after_space, self.other):
            if len(known) > CACHE:  # words met first are the frequent ones
                kept = dict(islice(known.items(), CACHE // 2))
                known.clear()
                known.update(kept)
        return [self._whole(t) if any(s in t for s in self.special) else c for t, c in zip(texts, self._cut(texts))]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _cut(self, texts: list[str]) -> list[bytes]:
        parts: list[tuple[str, list[str], str, list[bytes | None], bool]] = []
        missing, others = {}, {}
        get = self.after_space.get
        for text in texts:
            first, *rest = text.split(" ")
            last = ""
            got = list(map(get, rest))
            new = [] if all(got) else [c for c, g in zip(rest, got) if g is None]  # no chunk is without ids
            if rest and not (first and first[-1].strip() and all(c and c[0].strip() and c[-1].strip() for c in new)):
                first, *rest = CUT.split(text)
                if rest and not rest[-1][-1].strip():
                    last = rest.pop()
                rest = [c[1:] for c in rest]
                got = list(map(get, rest))
                new = [c for c, g in zip(rest, got) if g is None]
            missing.update(dict.fromkeys(new))
            others.update(dict.fromkeys(c for c in (first, last) if c not in self.other))
            parts.append((first, rest, last, got, bool(new)))
        self._learn(list(missing), list(others))
        known, other = self.after_space, self.other
        coded = []
        for first, rest, last, got, some in parts:
            if some:  # what was found is not looked up again
                got = [known[c] if g is None else g for c, g in zip(rest, got)]
            coded.append(other[first] + b"".join(got) + other[last])
        for kept, found in ((self.after_space, missing), (other, others)):
            for chunk in [c for c in found if len(c) > LONG]:
                del kept[chunk]
        return coded

    def _learn(self, chunks: list[str], others: list[str]) -> None:
        """Encodes new chunks, many at once where they cannot touch, taking the ids apart by their byte lengths."""
        for at in range(0, len(chunks), 512):
            group = chunks[at : at + 512]
            joined = "".join([" " + c for c in group])
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            ends = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum([len(c.encode()) + 1 for c in group])) + 1
            data, ends = ids.tobytes(), (ends * 4).tolist()
            self.after_space.update(zip(group, [data[i:j] for i, j in zip([0, *ends], ends)]))
        for chunk, coded in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False)):
            self.other[chunk] = np.array(coded.ids, "<u4").tobytes()


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> Encoder:
    """The worker's encoder, which keeps what it has learned from one task to the next."""
    return Encoder(path)


def seek_table(frames: list[tuple[int, int, int]]) -> bytes:
    body = b"".join(ENTRY.pack(*f) for f in frames) + struct.pack("<IBI", len(frames), CHECKSUMS, FOOTER)
    return struct.pack("<II", SKIPPABLE_TABLE, len(body)) + body


def checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class Reader:
    """Random access to one file of frames."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        n, flags, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
        if magic != FOOTER or not flags & CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        table = source.read_at(n * ENTRY.size, size - 9 - n * ENTRY.size)
        self.frames = np.frombuffer(table, "<u4").reshape(n, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        self.zstd = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.frames)

    def ids(self, frame: int) -> np.ndarray:
        """The ids of one document; only its frame is read."""
        packed, raw, kept = map(int, self.frames[frame])
        data = self.zstd.decompress(self.source.read_at(packed, int(self.starts[frame])), max_output_size=max(raw, 1))
        if len(data) != raw or checksum(data) != kept:
            raise ValueError(f"frame {frame} is damaged")
        return np.frombuffer(data, "<u4")

    def keys(self) -> np.ndarray:
        """The documents' keys, with the smallest integer for null."""
        at = int(self.starts[-1])
        return np.frombuffer(self.source.read_at(8 * len(self), at + 8), "<i8")


def _open(folder: str):
    """A folder's file system by its address: local, HDFS, S3 and others."""
    return pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder.removeprefix("file:"))


NULL_KEY = -(2**63)
MANIFEST = "file string, part int, documents long, ids long"


def write(docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", level: int = LEVEL) -> DataFrame:
    """Encodes whole texts into files under ``folder`` in ascending order of ``key``; returns the committed manifest.

    The key is a whole number; null comes first. A null or empty text is a document with the end id alone.
    Rows that share a key stand side by side, by a hash of their text. An empty table gives an empty manifest.
    """
    schema = T.StructType.fromDDL(MANIFEST)
    arrow = to_arrow_schema(schema)

    def run(batches):
        encoder, packer, out, name = worker_encoder(tokenizer), zstandard.ZstdCompressor(level=level), None, f"{uuid.uuid4().hex}.zst"
        store, base = _open(folder)
        frames, keys, part = [], [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, common.SLICE_ROWS):
                rows = batch.slice(start, common.SLICE_ROWS)
                part = rows.column(2)[0].as_py()
                if out is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                for coded in encoder.encode([(t or b"").decode("utf-8", "replace") for t in rows.column(1).to_pylist()]):
                    data = coded + END.to_bytes(4, "little")
                    packed = packer.compress(data)
                    out.write(packed)
                    frames.append((len(packed), len(data), checksum(data)))
                keys += [NULL_KEY if k is None else k for k in rows.column(0).to_pylist()]
        if out is None:
            return
        listed = np.array(keys, "<i8").tobytes()
        out.write(struct.pack("<II", SKIPPABLE_KEYS, len(listed)) + listed + seek_table(frames))
        out.close()
        yield pa.RecordBatch.from_pylist([{"file": name, "part": part, "documents": len(frames), "ids": sum(f[1] for f in frames) // 4}], arrow)

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"), F.xxhash64(text).alias("tie"))
    rows = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie")  # the sample of the ranges holds no texts
    rows = rows.select("key", "text", F.spark_partition_id().alias("part"))
    manifest = common.map_arrow(rows, run, schema)
    path = f"{folder.rstrip('/')}/manifest"
    manifest.write.mode("overwrite").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)



def read_back(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document of the files: key, file, frame, start (ids of all documents before), n_tokens, ids_crc32.

    Every frame is decompressed and checked; a task holds some hundred documents at a time.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    schema = T.StructType.fromDDL("key long, file string, frame long, start long, n_tokens long, ids_crc32 long")
    arrow = to_arrow_schema(schema)

    def run(batches):
        store, base = _open(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_file(f"{base}/{name}") as source:
                    reader = Reader(source)
                    numbered = enumerate(reader.keys().tolist())
                    while rows := list(islice(numbered, READ_ROWS)):
                        found = []
                        for frame, key in rows:
                            ids = reader.ids(frame)
                            found.append((None if key == NULL_KEY else key, name, frame, start, len(ids), zlib.crc32(ids.tobytes())))
                            start += len(ids)
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)

    spread = files.select("file", "base").repartition(max(1, manifest.count()))  # about a file a task
    return common.map_arrow(spread, run, schema)


def fetch(manifest: DataFrame, folder: str, places: DataFrame) -> DataFrame:
    """The ids of the documents asked for: (file, frame) rows, as ``read_back`` names them, with ``ids``.

    Only their frames are read and decompressed.
    """
    schema = T.StructType.fromDDL("file string, frame long, ids array<long>")
    arrow = to_arrow_schema(schema)
    wanted = places.select("file", F.col("frame").cast("long").alias("frame")).join(manifest.select("file"), "file", "left_semi")

    def run(batches):
        store, base = _open(folder)
        name, reader = None, None
        for batch in batches:
            for file, frame in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if file != name:
                    name, reader = file, Reader(store.open_input_file(f"{base}/{file}"))
                yield pa.RecordBatch.from_pylist([{"file": file, "frame": frame, "ids": reader.ids(frame).tolist()}], arrow)

    return common.map_arrow(wanted.repartition("file").sortWithinPartitions("file", "frame"), run, schema)


def tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the documents and reads the files back: (key, start, n_tokens, ids_crc32, file, frame)."""
    folder = folder or workspace(docs.sparkSession)
    manifest = write(docs, folder, tokenizer, key, text)
    return read_back(manifest, folder).withColumnRenamed("key", key)
