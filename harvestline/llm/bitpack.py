"""Token ids on disk: fixed-width bit packing with random access.

A shard file holds the documents of one range of doc_id, in ascending order:

    header   magic "HLBP0002", bits, block_ids (two little-endian uint32)
    blocks   block_ids ids each (the last one fewer) at ``bits`` bits an id, low
             bits first; a block starts at a byte of its own
    index    where each block starts, doc ids, then the end of each document in
             ids (int64 each)
    footer   number of blocks, documents, documents without an id (the first
             ones) and ids, offset of the index (int64 each), magic

``bits`` is the least that holds the vocabulary.  Any document is read by its
index entry, the offsets of the blocks that it touches and the bytes between,
unpacked eight ids at a time with numpy.  Shards are written by the tasks of a range partition through
pyarrow's file systems, under a name of the attempt and then renamed, so a
task that is run again leaves one whole file; a manifest table (one row a
shard) is what readers go by.

Defined results: a null or empty text is the end id alone; very long texts are
written whole, over as many blocks as they fill; rows that repeat a doc_id
follow one another, ordered by the hash of their text, over as many shards as
they fill; null doc_ids come first; an empty table gives no shard; columns
other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import new_folder, prepare, stored, text_buffers
from .tokenize import encoder

MAGIC = b"HLBP0002"
BLOCK_IDS = 1 << 16
#: Text bytes that go to one shard, about.
SHARD_BYTES = 32 << 20
MANIFEST = "path string, shard int, first_id long, last_id long, documents long, ids long, bits int"


def bits_for(vocabulary: int) -> int:
    """The least number of bits that holds ids 0 .. vocabulary - 1."""
    return max(1, int(vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Low bits first; the last byte is filled with zeros."""
    n = len(ids)
    x = np.zeros(-(-n // 8) * 8, np.uint64)
    x[:n] = ids
    x = x.reshape(-1, 8)
    out = np.zeros((len(x), bits), np.uint8)
    for lane in range(8):
        at, shift = divmod(lane * bits, 8)
        wide = x[:, lane] << np.uint64(shift)
        for k in range(-(-(shift + bits) // 8)):
            out[:, at + k] |= ((wide >> np.uint64(8 * k)) & np.uint64(255)).astype(np.uint8)
    return out.tobytes()[:-(-n * bits // 8)]


def unpack_bits(data: bytes, n: int, bits: int) -> np.ndarray:
    groups = -(-n // 8)
    raw = np.zeros(groups * bits, np.uint8)
    got = np.frombuffer(data, np.uint8)[:groups * bits]
    raw[:len(got)] = got
    raw = raw.reshape(groups, bits)
    out = np.empty((groups, 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for lane in range(8):
        at, shift = divmod(lane * bits, 8)
        wide = np.zeros(groups, np.uint64)
        for k in range(-(-(shift + bits) // 8)):
            wide |= raw[:, at + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, lane] = (wide >> np.uint64(shift)) & mask
    return out.reshape(-1)[:n]


class ShardWriter:
    def __init__(self, stream, bits: int, block_ids: int = BLOCK_IDS):
        if block_ids % 8:
            raise ValueError("a block must hold a multiple of eight ids")
        self.stream, self.bits, self.block_ids = stream, bits, block_ids
        self.docs: list[np.ndarray] = []
        self.ends: list[np.ndarray] = []
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = self.n_null = 0
        self.blocks: list[int] = []
        stream.write(MAGIC + struct.pack("<II", bits, block_ids))
        self.size = 16

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def _put_block(self, ids: np.ndarray) -> None:
        self.blocks.append(self.size)
        self._put(pack_bits(ids, self.bits))

    def add(self, docs: np.ndarray, ids: np.ndarray, lengths: np.ndarray, nulls: int = 0) -> None:
        """Documents one after another; the first ``nulls`` of them have no id."""
        self.n_null += nulls
        if len(ids) and int(ids.max()) >> self.bits:
            raise ValueError(f"an id needs more than {self.bits} bits")
        self.docs.append(np.asarray(docs, "<i8"))
        self.ends.append((self.n_ids + np.cumsum(lengths)).astype("<i8"))
        self.n_ids += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block_ids:
            whole = np.concatenate(self.held)
            cut = self.n_held // self.block_ids * self.block_ids
            for at in range(0, cut, self.block_ids):
                self._put_block(whole[at:at + self.block_ids])
            self.held, self.n_held = [whole[cut:]], self.n_held - cut

    def close(self) -> None:
        if self.n_held:
            self._put_block(np.concatenate(self.held))
        index = self.size
        docs = np.concatenate(self.docs) if self.docs else np.zeros(0, "<i8")
        ends = np.concatenate(self.ends) if self.ends else np.zeros(0, "<i8")
        starts = np.array(self.blocks, "<i8")
        self._put(starts.tobytes() + docs.tobytes() + ends.tobytes()
                  + struct.pack("<qqqqq", len(starts), len(docs), self.n_null, self.n_ids, index) + MAGIC)


class ShardReader:
    """Random access to one shard; holds its index and the blocks asked for."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        if source.read_at(8, 0) != MAGIC or source.read_at(8, size - 8) != MAGIC:
            raise ValueError("not a whole shard")
        self.bits, self.block_ids = struct.unpack("<II", source.read_at(8, 8))
        blocks, n, self.n_null, self.n_ids, index = struct.unpack("<qqqqq", source.read_at(40, size - 48))
        raw = np.frombuffer(source.read_at(8 * blocks + 16 * n, index), "<i8")
        self.blocks, self.docs, self.ends = raw[:blocks], raw[blocks:blocks + n], raw[blocks + n:]

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids first .. last - 1 of the shard."""
        if last <= first:
            return np.zeros(0, np.uint32)
        (a, skip), (b, take) = divmod(first, self.block_ids), divmod(last - 1, self.block_ids)
        begin = int(self.blocks[a]) + skip // 8 * self.bits
        data = self.source.read_at(int(self.blocks[b]) + (take // 8 + 1) * self.bits - begin, begin)
        lead = skip % 8  # blocks hold a multiple of eight ids, so what lies between two of them is unpacked at once
        return unpack_bits(data, lead + last - first, self.bits)[lead:]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))

    def runs(self, limit: int = 1 << 20):
        """(i, j, ids) for runs of whole documents of about ``limit`` ids."""
        i = 0
        while i < len(self.docs):
            begin = int(self.ends[i - 1]) if i else 0
            j = max(i + 1, int(np.searchsorted(self.ends, begin + limit, side="right")))
            yield i, j, begin, self.ids(begin, int(self.ends[j - 1]))
            i = j


def _write_task(folder: str, tokenizer: str, end_id: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]):
        enc, bits, writer = encoder(tokenizer), 0, None
        store, path = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        for batch in batches:
            data, off = text_buffers(batch.column("text"))
            column, at = batch.column("doc_id"), 0
            docs, null = column.fill_null(0).to_numpy(zero_copy_only=False), column.is_null().to_numpy(zero_copy_only=False)
            for ids, lengths in enc.encode(data, off, end_id):
                if writer is None:
                    bits = bits_for(max(enc.vocabulary, end_id + 1))
                    store.create_dir(path, recursive=True)
                    name = f"{path}/attempt-{uuid.uuid4().hex}"
                    stream = store.open_output_stream(name)
                    writer, first = ShardWriter(stream, bits, block_ids), column[at].as_py()
                writer.add(docs[at:at + len(lengths)], ids, lengths, int(null[at:at + len(lengths)].sum()))
                at += len(lengths)
                last = column[at - 1].as_py()
        if writer is not None:
            writer.close()
            stream.close()
            shard = TaskContext.get().partitionId()  # of a range partition: in the order of the shards
            final = f"{path}/shard-{shard:08d}.hlbp"
            store.move(name, final)
            n = sum(map(len, writer.docs))
            yield pa.RecordBatch.from_arrays(
                [pa.array([final]), pa.array([shard], pa.int32()), *(pa.array([x], pa.int64()) for x in (first, last, n, writer.n_ids)), pa.array([bits], pa.int32())],
                [c.split()[0] for c in MANIFEST.split(", ")])
    return run


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 1, block_ids: int = BLOCK_IDS,
          shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write ``docs`` (doc_id, text) to shard files in ``folder``; the manifest
    (stored there too), with ``before``: the ids of all earlier shards."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # the last key parts rows that are equal in all others
    order = ["doc_id", "_hash", "_row"]
    rows = rows.withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    ranged = rows.repartitionByRange(max(1, -(-total // shard_bytes)), *order).sortWithinPartitions(*order).select("doc_id", "text")
    manifest = stored(ranged.mapInArrow(_write_task(folder, tokenizer, end_id, block_ids), MANIFEST), "manifest")
    before = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return stored(manifest.withColumn("before", F.coalesce(before, F.lit(0))), "manifest")


def _read_task(folder: str):
    def run(batches: Iterator[pa.RecordBatch]):
        store, _ = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                with store.open_input_file(path) as source:
                    shard = ShardReader(source)
                    for i, j, begin, ids in shard.runs():
                        starts = np.concatenate(([begin], shard.ends[i:j - 1]))
                        raw = memoryview(ids.astype("<u4").tobytes())
                        crc = [zlib.crc32(raw[4 * (a - begin):4 * (b - begin)]) for a, b in zip(starts.tolist(), shard.ends[i:j].tolist())]
                        docs = shard.docs[i:j]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(docs, mask=np.arange(i, j) < shard.n_null), pa.array(starts + before),
                             pa.array(shard.ends[i:j] - starts), pa.array(crc, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_digests(manifest: DataFrame, folder: str) -> DataFrame:
    """From the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""
    n = max(1, manifest.count())  # a row a shard
    return manifest.select("path", "before").repartition(n, "path").mapInArrow(
        _read_task(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, folder: str | None = None, **options) -> DataFrame:
    """Write the files under the shared folder and read them back."""
    folder = folder or new_folder(docs.sparkSession, "token-shards")
    return read_digests(write(docs, tokenizer, folder, **options), folder)
