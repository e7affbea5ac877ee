"""Harmonic packing of token sequences into fixed-capacity bins.

A document's full capacities are sequences of their own.  Its rest falls into a
reciprocal-capacity class: class k holds lengths above capacity / (k + 1) and
up to capacity / k, the last class all shorter ones.  A bin of class k takes k
whole rests; the gap that they leave is filled by cutting one more rest of the
class, and what the cut leaves of it goes on as a rest.  Classes are filled
independently, and each class by many independent groups of rests, whose
number follows the tokens of the class, so no task sees more than a bounded
number of tokens.

What a group has left for less than a bin is packed again, end to end, with
the leftovers of other groups; the last bin of that is split at powers of two,
whose lengths need no padding.

Defined results: a null or empty text is the end id alone; very long texts are
cut at every capacity; rows that repeat a doc_id, or are equal, are packed each
on its own and spread over the groups like others; rests of equal length are
ordered by their row; an empty table gives an empty result; columns other than
doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, stored, text_buffers
from .tokenize import encoder

CAPACITY = 2048
END_ID = 1
#: Bins that one group of rests fills, and rests in it, about.
GROUP_BINS = 256
GROUP_ROWS = 1024
#: The last class: bins of it take as many rests as fit.
LAST_CLASS = 64


def piece_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Full capacities, then powers of two, that make ``n`` tokens; longest first."""
    out = [capacity] * (n // capacity)
    rest, size = n % capacity, capacity >> 1
    while rest:
        if rest >= size:
            out.append(size)
            rest -= size
        size >>= 1
    return out


def class_of(length: int, capacity: int = CAPACITY) -> int:
    return min(capacity // length, LAST_CLASS)


def fill_bins(lengths: list[int], k: int, capacity: int = CAPACITY) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Fill bins of class ``k`` with rests of ``lengths``: (full bins, leftovers) as
    lists of (rest, first token, tokens).  Whole rests are taken from the front,
    what fills the gaps is cut from the back."""
    bins, front, back, used = [], 0, len(lengths), 0  # used: tokens of the rest at the back that are cut off
    while True:
        current, total, at = [], 0, front
        while at < back and (len(current) < k or k == LAST_CLASS) and total + lengths[at] <= capacity and not (at == back - 1 and used):
            current.append((at, 0, lengths[at]))
            total, at = total + lengths[at], at + 1
        end, cut = back, used
        while total < capacity and end > at:
            take = min(capacity - total, lengths[end - 1] - cut)
            current.append((end - 1, cut, take))
            total, cut = total + take, cut + take
            if cut == lengths[end - 1]:
                end, cut = end - 1, 0
        if total < capacity:
            break
        bins.append(current)
        front, back, used = at, end, cut
    left = [(i, used if i == back - 1 else 0, lengths[i] - (used if i == back - 1 else 0)) for i in range(front, back)]
    return bins, left


def _ids_type(vocabulary: int):
    """What an id is held in until it is placed."""
    return np.uint16 if vocabulary <= 1 << 16 else np.uint32


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    """Full capacities, placed; and the rests with their class and ids."""
    def run(batches: Iterator[pa.RecordBatch]):
        enc = encoder(path)
        part, row, full = TaskContext.get().partitionId() << 33, 0, 0
        for batch in batches:
            data, off = text_buffers(batch.column("text"))
            docs, at_row = batch.column("doc_id").to_pylist(), 0
            out: list[dict] = []
            for ids, lengths in enc.encode(data, off, end_id):
                narrow, at = ids.astype(_ids_type(enc.vocabulary)), 0
                for n in lengths.tolist():
                    for start in range(0, n, capacity):
                        own = narrow[at + start:at + min(start + capacity, n)]
                        piece = {"doc_id": docs[at_row], "row": part + row, "start": start, "doc_tokens": n, "class": 0, "sequence": None,
                                 "length": len(own), "crc": None, "ids": own.tobytes()}
                        if len(own) == capacity:
                            piece |= {"sequence": part + full, "crc": zlib.crc32(own.astype("<u4"))}
                            full += 1
                            if not with_ids:
                                piece["ids"] = None
                        else:
                            piece["class"] = class_of(len(own), capacity)
                        out.append(piece)
                    at, row, at_row = at + n, row + 1, at_row + 1
            yield pa.RecordBatch.from_pylist(out, _SCHEMA)
        pa.default_memory_pool().release_unused()  # the worker goes on to other tasks
    return run


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("doc_tokens", pa.int64()), ("class", pa.int32()),
                     ("sequence", pa.int64()), ("length", pa.int64()), ("crc", pa.int64()), ("ids", pa.binary())])
_CUT = "doc_id long, row long, start long, doc_tokens long, class int, sequence long, length long, crc long, ids binary"


_FILLED = "doc_id long, row long, start long, doc_tokens long, class int, sequence long, offset long, length long, crc long, ids binary"
_FILLED_SCHEMA = pa.schema([*(f for f in _SCHEMA if f.name in ("doc_id", "row", "start", "doc_tokens", "class", "sequence")), ("offset", pa.int64()),
                            *(f for f in _SCHEMA if f.name in ("length", "crc", "ids"))])


def _placed(rests: list[tuple], ids: list[np.ndarray], bins: list, kind: int, number, with_ids: bool) -> list[dict]:
    """The pieces in ``bins``; ``number`` gives the sequence of a bin."""
    out = []
    for b, content in enumerate(bins):
        offset = 0
        for i, first, n in content:
            own, (doc, row, start, tokens) = ids[i][first:first + n], rests[i]
            out.append({"doc_id": doc, "row": row, "start": start + first, "doc_tokens": tokens, "class": kind, "sequence": number(b),
                        "offset": offset, "length": n, "crc": zlib.crc32(own.astype("<u4")), "ids": own.tobytes() if with_ids else None})
            offset += n
    return out


def _group_task(dtype, capacity: int, last: bool, with_ids: bool):
    """Fill the bins of one group.  Leftovers keep a class above 0 and their ids; in
    the ``last`` pass they are split at powers of two."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        k, group = (x.as_py() for x in key)
        table = table.sort_by([("row", "ascending"), ("start", "ascending")])
        rests = list(zip(*(table.column(c).to_pylist() for c in ("doc_id", "row", "start", "doc_tokens"))))
        ids = [np.frombuffer(x.as_buffer(), dtype) for x in table.column("ids")]
        bins, left = fill_bins([len(x) for x in ids], LAST_CLASS if last else k, capacity)
        base = (2 if last else 1) << 60 | k << 52 | group << 22
        out = _placed(rests, ids, bins, 0, lambda b: base | b, with_ids)
        if last:
            sizes, ends, room = piece_lengths(sum(n for *_, n in left), capacity), [], 0
            for i, first, n in left:
                while n:
                    if not room:
                        ends.append([])
                        room = sizes[len(ends) - 1]
                    take = min(n, room)
                    ends[-1].append((i, first, take))
                    first, n, room = first + take, n - take, room - take
            out += _placed(rests, ids, ends, 0, lambda b: base | len(bins) + b, with_ids)
        else:
            out += _placed(rests, ids, [[x] for x in left], k, lambda b: None, True)
        return pa.Table.from_pylist(out, _FILLED_SCHEMA)
    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every token of every row of ``docs`` (doc_id, text) in exactly one piece of one
    sequence: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and
    with ``with_ids`` the ids as little-endian uint32."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    prepare(docs.sparkSession)
    cut = stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _pieces(tokenizer, capacity, end_id, with_ids), _CUT), "pieces")
    dtype = _ids_type(encoder(tokenizer).vocabulary)
    rests = cut.where("class > 0")

    def group(of: DataFrame):
        """Groups of a bounded size by class; equal rows have numbers of their own."""
        n = F.lit(1)
        for r in of.groupBy("class").agg(F.sum("length").alias("tokens"), F.count(F.lit(1)).alias("rows")).collect():  # a row a class
            groups = max(1, r["tokens"] // (capacity * GROUP_BINS), r["rows"] // GROUP_ROWS)
            n = F.when(F.col("class") == r["class"], F.lit(groups)).otherwise(n)
        return of.withColumn("group", F.pmod(F.xxhash64("row"), n.cast("long")))

    filled = stored(group(rests).groupBy("class", "group").applyInArrow(_group_task(dtype, capacity, False, with_ids), _FILLED), "filled")
    left = filled.where("class > 0").withColumn("class", F.lit(0))
    ends = group(left).groupBy("class", "group").applyInArrow(_group_task(dtype, capacity, True, with_ids), _FILLED)
    full = cut.where("class = 0").withColumn("offset", F.lit(0).cast("long"))
    cols = ["doc_id", "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", F.col("sequence").alias("sequence_id"), "offset"]
    out = [x.select(*cols, *(["ids"] if with_ids else [])) for x in (full, filled.where("class = 0"), ends)]
    whole = out[0].unionByName(out[1]).unionByName(out[2])
    return whole.withColumn("ids", _widened(whole["ids"], dtype)) if with_ids else whole


def _widened(ids, dtype):
    """Ids as little-endian uint32."""
    if dtype == np.uint32:
        return ids

    @F.arrow_udf("binary")
    def widen(held: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(x.as_buffer(), dtype).astype("<u4").tobytes() for x in held], pa.binary())

    return widen(ids)
