"""N-gram Jaccard join: a size-aware heavy-light set similarity join.

Two texts link when the Jaccard similarity of their word-shingle sets is at
least ``num/den``.  The result is exact: candidates come from filters that
lose no link, and every candidate is verified on whole sets.

1. *Classes.*  Texts with equal sets (equal size and 128-bit set hash) form a
   class; one member stands for it from here on.
2. *Order.*  Any common order of shingles makes prefix filtering exact.  The
   order here is (known frequent, hash).  Frequent shingles are counted over
   all texts: once over every prefix, and once over the whole sets of the
   texts whose prefix is full of frequent ones.  At most ``heavy_keys`` of
   them, the most frequent, are broadcast (8 bytes each); leaving others out
   changes the cost, never the result.
3. *Light sets* (``n <= boundary``): two similar sets share a 2-subset of
   their extended prefixes (``n - need + 2``); each light set emits the hash
   of every such subset.
4. *Heavy sets*: inverted lists of single prefix shingles are scanned; a
   light set joins them only where its size can match a heavy one.
   ``boundary`` minimises subsets emitted against list entries scanned,
   from the size histogram and the measured list length.
5. *Lists.*  In lists of up to ``list_rows`` rows all feasible pairs (size
   and position bounds) are candidates.  Longer lists, and lists of frequent
   shingles (salted before the shuffle), link each row to the most central
   row of its list first.
   Rows that this leaves in different components are then paired across
   components, subject to the same bounds, so that no link that could join
   two components stays unverified.  Links inside a component are not all
   enumerated: component ids need none of them.
6. Components follow from verified links and class membership.

Defined results: a null or wordless text has no shingles and links with
nothing; rows that repeat a doc_id count as one node; a null doc_id links
with nothing and its component is null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, batch_rows, prepare, row_groups, small_side, stored, text_buffers
from .components import connected_components
from .kernels import SEGMENT, shingle_sets

LIST_ROWS = 16
HEAVY_KEYS = 1_000_000
LARGEST_BOUNDARY = 64
#: Arrow batches: rows of numbers, and pairs of whole sets.
NARROW_ROWS = 20_000
SET_PAIRS = 50
_U = np.uint64


def need(n: int, num: int, den: int) -> int:
    """Least overlap of a set of size ``n`` with any similar set."""
    return -(-num * n // den)


def prefix_length(n: int, k: int, num: int, den: int) -> int:
    return n - need(n, num, den) + k


def _sets(batch: pa.RecordBatch, width: int):
    data, off = text_buffers(batch.column("text"))
    ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
    for a, b in row_groups(off, SEGMENT):
        for i, s in enumerate(shingle_sets(data[off[a]:off[b]], off[a:b + 1] - off[a], width), a):
            yield ids[i], s


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rows, n, c1, c2 = batch.column("doc_id"), [], [], []
            data, off = text_buffers(batch.column("text"))
            for a, b in row_groups(off, SEGMENT):
                for s in shingle_sets(data[off[a]:off[b]], off[a:b + 1] - off[a], width):
                    n.append(len(s))
                    with np.errstate(over="ignore"):
                        x = (s ^ (s >> _U(29))) * _U(0xD6E8FEB86659FD93)
                        y = (s ^ (s >> _U(31))) * _U(0xA0761D6478BD642F)
                        c1.append(np.bitwise_xor.reduce(x ^ (x >> _U(32))) if len(s) else 0)
                        c2.append((y ^ (y >> _U(30))).sum(dtype=_U) if len(s) else 0)
            yield pa.RecordBatch.from_arrays(
                [rows, pa.array(n, pa.int64()), pa.array(np.array(c1, _U).view(np.int64)),
                 pa.array(np.array(c2, _U).view(np.int64))], ["doc_id", "n", "c1", "c2"])
    return run


def _heavy_mask(s: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    if not len(heavy) or not len(s):
        return np.zeros(len(s), bool)
    at = np.searchsorted(heavy, s)
    at[at == len(heavy)] = 0
    return heavy[at] == s


def _counted(width: int, num: int, den: int, heavy_ref=None):
    """(key, cnt): prefix shingles of every text; or, with ``heavy_ref``, all
    shingles of the texts whose prefix is a quarter or more frequent ones."""
    def run(batches: Iterator[pa.RecordBatch]):
        heavy = heavy_ref.value if heavy_ref is not None else None
        for batch in batches:
            keys = []
            for _, s in _sets(batch, width):
                n = len(s)
                if not n:
                    continue
                p = prefix_length(n, 1, num, den)
                if heavy is None:
                    keys.append(s[:p])
                elif 4 * _heavy_mask(s[:p], heavy).sum() >= p:
                    keys.append(s)
            k, c = np.unique(np.concatenate(keys) if keys else np.zeros(0, _U), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c.astype(np.int64))], ["key", "cnt"])
    return run


def _postings(width: int, num: int, den: int, boundary: int, heavy_ref):
    """(key, salt, hot, id, n, pos): single prefix shingles (pos counts from 0)
    and hashed 2-subsets of light sets (pos -1)."""
    least_heavy = need(boundary + 1, num, den)

    def run(batches: Iterator[pa.RecordBatch]):
        heavy = heavy_ref.value
        for batch in batches:
            key, hot, pos, sizes, ids, counts = [], [], [], [], [], []
            for i, s in _sets(batch, width):
                n = len(s)
                if n < 2:
                    continue  # its only possible partner is an equal set
                mask = _heavy_mask(s, heavy)
                order = np.concatenate((s[~mask], s[mask])) if mask.any() else s
                rare = n - int(mask.sum())
                got = 0
                if n <= boundary:
                    p = prefix_length(n, 2, num, den)
                    a, b = np.triu_indices(min(p, n), 1)
                    with np.errstate(over="ignore"):
                        # a subset's hash must not depend on the order of its members
                        lo, hi = np.minimum(order[a], order[b]), np.maximum(order[a], order[b])
                        x = (lo * _U(0x9E3779B97F4A7C15)) ^ (hi + (lo >> _U(7)))
                        x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
                    key.append(x ^ (x >> _U(32)))
                    hot.append(np.zeros(len(a), bool))
                    pos.append(np.full(len(a), -1, np.int32))
                    got += len(a)
                if n > boundary or n >= least_heavy:
                    p = prefix_length(n, 1, num, den)
                    key.append(order[:p])
                    at = np.arange(p, dtype=np.int32)
                    hot.append(at >= rare)
                    pos.append(at)
                    got += p
                ids.append(i)
                sizes.append(n)
                counts.append(got)
            if not ids:
                continue
            key, hot, pos = np.concatenate(key), np.concatenate(hot), np.concatenate(pos)
            ident = np.repeat(np.array(ids, np.int64), counts)
            # rows of a frequent shingle are only passed on: spread them
            salt = np.where(hot, (ident % 1024 + 1).astype(np.int32), 0).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(salt), pa.array(ident),
                 pa.array(np.repeat(np.array(sizes, np.int32), counts)), pa.array(pos)],
                ["key", "salt", "id", "n", "pos"])
    return run


def _pairs_of_lists(list_rows: int, boundary: int, num: int, den: int):
    """Rows sorted by (salt, key) → candidate pairs of short lists (kind 0) and the rows
    of long or frequent lists (kind 1).  Holds at most one list of
    ``list_rows`` rows besides the batch."""
    names = ["kind", "a", "b", "key", "n", "pos"]

    def passed(key, ident, n, pos):
        m = len(key)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ones(m, np.int32)), pa.array(ident), pa.nulls(m, pa.int64()),
             pa.array(key), pa.array(n), pa.array(pos)], names)

    def feasible(na, nb, i, j):
        first = np.minimum(na - i, nb - j)
        within = (num * np.maximum(na, nb) <= den * np.minimum(na, nb))
        reach = (num + den) * first >= num * (na + nb)
        single = i >= 0
        heavy = np.maximum(na, nb) > boundary
        return within & np.where(single, reach & heavy, True)

    def short(key, ident, n, pos, starts, lengths):
        found = []
        for m in np.unique(lengths):
            at = starts[lengths == m]
            x, y = np.triu_indices(m, 1)
            i, j = (at[:, None] + x).ravel(), (at[:, None] + y).ravel()
            ok = feasible(n[i].astype(np.int64), n[j].astype(np.int64), pos[i], pos[j]) & (ident[i] != ident[j])
            i, j = i[ok], j[ok]
            found.append(np.stack((np.minimum(ident[i], ident[j]), np.maximum(ident[i], ident[j])), 1))
        got = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
        m = len(got)
        none32, none64 = pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(m, np.int32)), pa.array(np.ascontiguousarray(got[:, 0])),
             pa.array(np.ascontiguousarray(got[:, 1])), none64, none32, none32], names)

    def run(batches: Iterator[pa.RecordBatch]):
        held = None  # the unfinished last list
        long_key = None  # the list that is being passed on
        for batch in batches:
            key, salt, ident, n, pos = (batch.column(c).to_numpy(zero_copy_only=False)
                                        for c in ("key", "salt", "id", "n", "pos"))
            if salt.any():
                hot = salt > 0
                yield passed(key[hot], ident[hot], n[hot], pos[hot])
                key, ident, n, pos = key[~hot], ident[~hot], n[~hot], pos[~hot]
            if not len(key):
                continue
            if held is not None:
                key, ident, n, pos = (np.concatenate(x) for x in zip(held, (key, ident, n, pos)))
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            lengths = np.diff(np.append(starts, len(key)))
            is_long = lengths > list_rows
            if long_key is not None and key[0] == long_key:
                is_long[0] = True
            out = np.repeat(is_long, lengths)
            last = slice(starts[-1], None)
            if is_long[-1]:
                held, long_key = None, key[-1]
            else:
                held, long_key = (key[last], ident[last], n[last], pos[last]), None
            if out.any():
                yield passed(key[out], ident[out], n[out], pos[out])
            use = ~is_long & (lengths > 1)
            use[-1] = False
            if use.any():
                yield short(key, ident, n, pos, starts[use], lengths[use])
        if held is not None and len(held[0]) > 1:
            yield short(*held, np.array([0]), np.array([len(held[0])]))
    return run


def _whole_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ids, sets = [], []
            for i, s in _sets(batch, width):
                ids.append(i)
                sets.append(s.tobytes())
                if sum(map(len, sets[-50:])) > 4_000_000 or len(ids) >= 500:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], ["id", "s"])
                    ids, sets = [], []
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], ["id", "s"])
    return run


def _verify(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int((y[at] == x).sum())
                keep.append(den * both >= num * (len(x) + len(y) - both))
            keep = np.array(keep, bool)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])
    return run


def best_boundary(histogram: dict[int, int], list_length: float, num: int, den: int) -> int:
    """The size up to which enumerating 2-subsets is cheaper than scanning
    inverted lists of ``list_length`` rows on average."""
    best, cost, boundary = 0.0, 0.0, 1
    for n in range(2, LARGEST_BOUNDARY + 1):
        c = histogram.get(n, 0)
        subsets = comb(min(n, prefix_length(n, 2, num, den)), 2)
        scanned = prefix_length(n, 1, num, den) * (1 + list_length)
        cost += c * (subsets - scanned)
        if cost <= best:
            best, boundary = cost, n
    return boundary


def shingle_classes(docs: DataFrame, width: int = 5) -> DataFrame:
    """(doc_id, n, rep): the set size of each row, and the smallest doc_id with
    the same set (null for empty sets).  ``docs`` has doc_id and text."""
    sig = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _signatures(width), "doc_id long, n long, c1 long, c2 long")
    sig = stored(sig, "signatures")
    reps = sig.where("n > 0 and doc_id is not null").groupBy("n", "c1", "c2").agg(F.min("doc_id").alias("rep"))
    return stored(sig.join(reps, ["n", "c1", "c2"], "left").select(
        "doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("rep")), "classes")


def _frequent(counts: DataFrame, list_rows: int, heavy_keys: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent of counted keys, with their counts: at most ``heavy_keys``, 16 bytes
    each.  As Arrow: tasks sort them, and the driver's JVM and Python hold no row objects."""
    top = counts.where(F.col("cnt") > list_rows).orderBy(F.desc("cnt"), "key").limit(heavy_keys)
    with batch_rows(counts.sparkSession, NARROW_ROWS):
        table = top.toArrow()
    return table["key"].to_numpy(), table["cnt"].to_numpy()


def _union(first, second, heavy_keys: int) -> np.ndarray:
    """The most frequent of both, sorted as unsigned numbers."""
    key, cnt = (np.concatenate(x) for x in zip(first, second))
    order = np.lexsort((key, -cnt))
    key = key[order]
    _, at = np.unique(key, return_index=True)  # a key's larger count comes first
    return np.sort(key[np.sort(at)[:heavy_keys]].view(_U))


def members(classes: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """Of the ids that do not stand for one text alone: (doc_id) of those whose set another
    text stands for, and (doc_id) of those that several rows have.  None where there are
    none, so that no plan carries joins for them."""
    ids = stored(classes.where("doc_id is not null").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("c"), F.max("rep").alias("rep")).where("c > 1 or rep <> doc_id"), "ids")
    n = ids.agg(F.count_if(F.col("c") == 1).alias("copies"), F.count_if(F.col("c") > 1).alias("repeated")).first()

    def side(rows: DataFrame, count: int) -> DataFrame | None:
        if not count:
            return None
        return F.broadcast(rows) if count <= BROADCAST_ROWS else rows

    return side(ids.where("c = 1").select("doc_id"), n.copies), side(ids.where("c > 1").select("doc_id"), n.repeated)


def components_of_sets(docs: DataFrame, classes: DataFrame, copies: DataFrame | None, repeated: DataFrame | None,
                       width: int = 5, num: int = 3, den: int = 4,
                       list_rows: int = LIST_ROWS, heavy_keys: int = HEAVY_KEYS) -> DataFrame:
    """(node, component), stored, of class members (and of ids that several rows have) that
    links connect to others, straight or by way of further texts; ``copies`` and
    ``repeated`` are those of ``members``."""
    spark = docs.sparkSession
    # members that another text of the same set stands for; ids used twice keep all their rows
    distinct = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    if copies is not None:
        distinct = distinct.join(copies, "doc_id", "left_anti")

    def counted(ref=None) -> DataFrame:
        keys = distinct.mapInArrow(_counted(width, num, den, ref), "key long, cnt long")
        return keys.groupBy("key").agg(F.sum("cnt").alias("cnt")).where("cnt > 1")

    shared = stored(counted(), "shared")
    frequent = _frequent(shared, list_rows, heavy_keys)
    heavy = _union(frequent, frequent, heavy_keys)
    if len(heavy):
        ref = spark.sparkContext.broadcast(heavy)
        heavy = _union(frequent, _frequent(counted(ref), list_rows, heavy_keys), heavy_keys)
        ref.destroy()
    ref = spark.sparkContext.broadcast(heavy)

    row = shared.where(F.col("cnt") <= list_rows).agg(
        F.sum(F.col("cnt") * F.col("cnt")).alias("s"), F.sum("cnt").alias("c")).first()
    sizes = {r.n: r["count"] for r in classes.where(F.col("n") <= LARGEST_BOUNDARY).groupBy("n").count().collect()}
    boundary = best_boundary(sizes, (row.s or 0) / (row.c or 1), num, den)

    posted = distinct.mapInArrow(_postings(width, num, den, boundary, ref),
                                 "key long, salt int, id long, n int, pos int")
    lists = (posted.repartition("key", "salt").sortWithinPartitions("salt", "key")
                   .mapInArrow(_pairs_of_lists(list_rows, boundary, num, den),
                               "kind int, a long, b long, key long, n int, pos int"))
    with batch_rows(spark, NARROW_ROWS):
        lists = stored(lists, "lists")
    ref.destroy()
    light = lists.where("kind = 0").select("a", "b")
    long_lists = stored(lists.where("kind = 1").select("key", F.col("a").alias("id"), "n", "pos"), "long-lists")

    # the most central row of each long list: the one that shares most list rows
    size = long_lists.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    score = (long_lists.join(size, "key").groupBy("id").agg(F.sum("c").alias("score")))
    scored = long_lists.join(score, "id")
    centre = scored.groupBy("key").agg(F.max(F.struct("score", "n", "id", "pos")).alias("m"), F.count(F.lit(1)).alias("c"))
    centre = centre.where("c > 1").select("key", F.col("m.id").alias("cid"), F.col("m.n").alias("cn"), F.col("m.pos").alias("cpos"))

    def bound(na, nb, i, j):
        na, nb = F.col(na), F.col(nb)
        single = (F.lit(num + den) * F.least(na - F.col(i), nb - F.col(j)) >= F.lit(num) * (na + nb)) & (
            F.greatest(na, nb) > boundary)
        return (F.lit(num) * F.greatest(na, nb) <= F.lit(den) * F.least(na, nb)) & (F.col(i).eqNullSafe(F.lit(-1)) | single)

    def ordered(x, y):
        return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")

    star = (long_lists.join(centre, "key").where((F.col("id") != F.col("cid")) & bound("n", "cn", "pos", "cpos"))
                      .select(*ordered("id", "cid")))
    tested = stored(light.unionByName(star).distinct(), "pairs")
    wanted = stored(tested.select(F.col("a").alias("doc_id")).unionByName(tested.select(F.col("b").alias("doc_id")))
                          .unionByName(long_lists.select(F.col("id").alias("doc_id"))).distinct(), "wanted")
    sets = stored(distinct.join(small_side(wanted), "doc_id", "left_semi")
                          .mapInArrow(_whole_sets(width), "id long, s binary"), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
                     .join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b"))
        with batch_rows(spark, SET_PAIRS):
            return stored(both.select("a", "b", "sa", "sb").mapInArrow(_verify(num, den), "a long, b long"), "links")

    links = verified(tested)
    if repeated is not None:
        links = links.unionByName(classes.join(repeated, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    parts = stored(connected_components(links), "parts")
    rows = (long_lists.join(parts.withColumnRenamed("node", "id"), "id", "left")
                      .withColumn("part", F.coalesce("component", "id")).drop("component"))
    open_lists = rows.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("key")
    rows = stored(rows.join(open_lists, "key"), "open-lists")
    left, right = rows.alias("x"), rows.select(
        "key", F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("pos").alias("pos2"), F.col("part").alias("part2"))
    rest = (left.join(right, "key").where((F.col("id") < F.col("id2")) & (F.col("part") != F.col("part2"))
                                          & bound("n", "n2", "pos", "pos2"))
                .select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct()
                .join(tested, ["a", "b"], "left_anti"))
    across = verified(rest)
    if across.isEmpty():
        return parts
    # links between parts join whole parts, far fewer than texts
    part_of = parts.unionByName(across.select(F.col("a").alias("node")).unionByName(across.select(F.col("b").alias("node"))).distinct()
                                      .join(parts, "node", "left_anti").select("node", F.col("node").alias("component")))
    joined = connected_components(across.join(part_of.select(F.col("node").alias("a"), F.col("component").alias("x")), "a")
                                        .join(part_of.select(F.col("node").alias("b"), F.col("component").alias("y")), "b")
                                        .select(F.col("x").alias("a"), F.col("y").alias("b")))
    return stored(part_of.join(joined.select(F.col("node").alias("component"), F.col("component").alias("whole")), "component", "left").select(
        "node", F.coalesce("whole", "component").alias("component")), "parts")


def _linked(docs: DataFrame, width: int, num: int, den: int, **options) -> tuple[DataFrame, DataFrame | None]:
    """What ``ngram_components`` returns, and the ids that several rows have (None: no such id)."""
    prepare(docs.sparkSession)
    classes = shingle_classes(docs, width)
    copies, repeated = members(classes)
    parts = components_of_sets(docs, classes, copies, repeated, width, num, den, **options)
    # a row goes by its class, and a row whose doc_id stands for several texts by that, which the parts hold where it matters
    own = classes.join(parts.select(F.col("node").alias("doc_id"), F.col("component").alias("own")), "doc_id", "left")
    out = own.join(parts.select(F.col("node").alias("rep"), F.col("component").alias("by_class")), "rep", "left")
    found = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("own", "by_class", "rep", "doc_id").alias("component_id"))
    return found, repeated


def ngram_components(docs: DataFrame, width: int = 5, num: int = 3, den: int = 4, **options) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    return _linked(docs, width, num, den, **options)[0]


def keep_representatives(docs: DataFrame, width: int = 5, num: int = 3, den: int = 4, **options) -> DataFrame:
    """The rows of ``docs`` whose doc_id is their component's smallest (one
    of rows that repeat it; every row with a null doc_id)."""
    found, repeated = _linked(docs, width, num, den, **options)
    gone = stored(found.where("component_id <> doc_id").select("doc_id").distinct(), "duplicates")
    kept = docs.join(small_side(gone), "doc_id", "left_anti")
    if repeated is None:
        return kept
    one = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(one.select(docs.columns))
