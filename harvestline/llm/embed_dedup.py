"""Embedding near-duplicates by sorted projection passes.

Each pass hashes the unit vectors of a label by random projections, each cut
into cells of one width with a random offset, and orders the vectors
lexicographically by the concatenated cells.  Every vector is compared with
the ``window`` vectors that follow it in that order, and the verified pairs of
all passes are united.  Where a run of equal hashes is longer than the window,
the window grows to the whole run, block against block, so vectors that agree
in all cells always meet.

Whether two vectors agree in all cells depends on their own distance alone, not
on where the vectors of the label lie or how dense they are: a common mean or a
crowded cone makes runs longer, never recall lower.  The number of passes
follows from that probability: a pair at exactly the threshold agrees in some
pass with probability ``recall``; what meets as neighbours besides is extra.
The number of projections and the width are chosen for each label by cost, from
the runs that a bounded sample of it fills.  The choice changes cost, not recall.

The order of all passes and labels is one sort across the cluster; its ranks
are cut into blocks of ``window`` rows, and a task compares a block with itself
and the next one, so a hot label is as many tasks as it has blocks.

Equal vectors are one class before that, so copies fill no cells.  The passes
emit only pairs that connect; the links inside each component are then counted
exactly, block against block, without emitting a pair.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components, and rows with a null label or vec_id, link with
nothing; vectors of different lengths never link; a pair at exactly the
threshold links; vectors with equal hashes are ordered by vec_id; repeated rows
are copies; very long vectors are projected like others; an empty table gives
an empty result; columns other than the three named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, erf, exp, log, pi, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import surrogate_key
from .common import prepare, small_side, stored
from .components import connected_components

#: Vectors that each one is compared with in the order of a pass, at least.
WINDOW = 256
RECALL = 0.9999
COUNT_ROWS = 512
#: Rows of a label from which the cost of its passes is measured.
SAMPLE_ROWS = 20_000
#: Comparisons that cost as much as sending one row.
ROW_COST = 1000
#: Cell widths, in distances of a pair at the threshold, and numbers of projections to choose from.
WIDTHS = (4, 12)
BITS = (2, 4, 6, 9, 12, 16, 20, 26)
PLANE_CACHE = 64 << 20


def together(width: float) -> float:
    """Probability that two vectors share a cell of ``width`` times their distance."""
    return erf(width / sqrt(2)) - 2 / (sqrt(2 * pi) * width) * (1 - exp(-width * width / 2))


def passes_for(bits: int, width: float, recall: float) -> int:
    """Passes after which a pair at the threshold has met with probability ``recall``."""
    met = together(width) ** bits
    return max(1, ceil(log(1 - recall) / log(1 - met))) if met < 1 else 1


def _choices(recall: float) -> list[tuple[int, int, int]]:
    """(projections, width, passes)"""
    return [(b, w, passes_for(b, w, recall)) for w in WIDTHS for b in BITS]


def _directions(vectors: list[np.ndarray]) -> np.ndarray:
    x = np.stack(vectors).astype(np.float64)
    # first to a safe range, so that no square overflows or vanishes
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class _Planes:
    """Projections and offsets of a pass, the same in every worker."""

    def __init__(self, seed: int):
        self.seed, self.held, self.size = seed, {}, 0

    def of(self, dim: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        if (dim, k) in self.held:
            return self.held[dim, k]
        rng = np.random.default_rng([self.seed, dim, k])
        got = (rng.standard_normal((dim, BITS[-1])), rng.random(BITS[-1]))
        if self.size + got[0].nbytes <= PLANE_CACHE:
            self.held[dim, k], self.size = got, self.size + got[0].nbytes
        return got

    def keys(self, x: np.ndarray, k: int, bits: int, width: float) -> list[bytes]:
        """The concatenated cells of each row, two bytes a cell, in an order that bytes keep
        (cells beyond that range are one)."""
        u, offset = self.of(x.shape[1], k)
        cells = np.floor(x @ u[:, :bits] / width + offset[:bits])
        raw = (np.clip(cells, -32768, 32767) + 32768).astype(">u2").tobytes()
        return [raw[i:i + 2 * bits] for i in range(0, len(raw), 2 * bits)]


def _by_dim(batch: pa.RecordBatch):
    dims = np.array([len(v) for v in batch.column("v")], np.int64)
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        yield int(d), at, _directions([batch.column("v")[int(i)].values.to_numpy(zero_copy_only=False) for i in at])


def _trial_task(distance: float, choices: list, seed: int):
    def run(batches: Iterator[pa.RecordBatch]):
        planes = _Planes(seed)
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            for d, at, x in _by_dim(batch):
                for c, (bits, width, _) in enumerate(choices):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(label[at]), pa.array(np.full(len(at), d, np.int32)), pa.array(np.full(len(at), c, np.int32)),
                         pa.array(planes.keys(x, 0, bits, distance * width))], ["label", "dim", "choice", "key"])
    return run


def _key_task(distance: float, choices: list, seed: int):
    def run(batches: Iterator[pa.RecordBatch]):
        planes = _Planes(seed)
        for batch in batches:
            rep, label, choice = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "label", "choice"))
            for d, at, x in _by_dim(batch):
                for c in np.unique(choice[at]):
                    bits, width, passes = choices[int(c)]
                    own = choice[at] == c
                    row, xs = at[own], x[own]
                    for k in range(passes):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(rep[row]), pa.array(label[row]), pa.array(np.full(len(row), d, np.int32)),
                             pa.array(np.full(len(row), k, np.int32)), pa.array(planes.keys(xs, k, bits, distance * width))],
                            ["rep", "label", "dim", "pass", "key"])
    return run


def _window_task(threshold: float, window: int):
    """Pairs of a block and what follows within the window."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank", kind="stable")
        rank, rep, group = pdf["rank"].to_numpy(), pdf["rep"].to_numpy(), pdf[["label", "dim", "pass"]].to_numpy()
        out = [np.zeros((0, 2), np.int64)]
        edges = np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]).any(axis=1), [True])))
        for a, b in zip(edges[:-1], edges[1:]):
            left = np.flatnonzero((rank[a:b] - 1) // window == key[0])
            if b - a < 2 or not len(left):
                continue
            x, r, at = _directions(list(pdf["v"].iloc[a:b])), rep[a:b], rank[a:b]
            ahead = at - at[left][:, None]
            p, q = np.nonzero((x[left] @ x.T >= threshold) & (ahead > 0) & (ahead <= window))
            out.append(_forest(np.stack((r[left[p]], r[q]), 1)))
        got = _forest(np.concatenate(out))
        return pd.DataFrame({"a": got[:, 0], "b": got[:, 1]})
    return run


def _run_task(threshold: float):
    """Pairs of two blocks of a run of equal hashes."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = key[-2:]
        x, rep, blk = _directions(list(pdf["v"])), pdf["rep"].to_numpy(), pdf["blk"].to_numpy()
        left, right = np.flatnonzero(blk == i), np.flatnonzero(blk == j)
        near = (x[left] @ x[right].T) >= threshold
        if i == j:
            near = np.triu(near, 1)
        p, q = np.nonzero(near)
        got = _forest(np.stack((rep[left[p]], rep[right[q]]), 1))
        return pd.DataFrame({"a": got[:, 0], "b": got[:, 1]})
    return run


def _forest(pairs: np.ndarray) -> np.ndarray:
    """The pairs that join two parts; the others connect nothing new, and links are
    counted later."""
    part: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := part.setdefault(x, x)) != x:
            part[x] = x = part[y] if y in part else y
        return x

    kept = []
    for a, b in pairs.tolist():
        x, y = root(a), root(b)
        if x != y:
            part[max(x, y)] = min(x, y)
            kept.append((a, b))
    return np.array(kept, np.int64).reshape(-1, 2)


def _count_task(threshold: float):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        x = _directions(list(pdf["v"]))
        c, blk = pdf["c"].to_numpy(np.int64), pdf["blk"].to_numpy()
        left, right = np.flatnonzero(blk == i), np.flatnonzero(blk == j)
        near = (x[left] @ x[right].T) >= threshold
        if i == j:
            np.fill_diagonal(near, False)
        links = np.zeros(len(pdf), np.int64)
        links[left] += near @ c[right]
        if i != j:
            links[right] += near.T @ c[left]
        return pd.DataFrame({"rep": pdf["rep"], "links": links})
    return run


def _plan(classes: DataFrame, distance: float, choices: list, window: int, row_cost: float, seed: int) -> DataFrame:
    """(label, dim, choice): the cheapest choice for the runs that a sample fills."""
    sizes = stored(classes.groupBy("label", F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")), "label-sizes")
    rate = F.least(F.lit(1.0), F.lit(float(SAMPLE_ROWS)) / F.col("n"))
    draw = F.pmod(F.xxhash64("rep", F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    some = (classes.select("rep", "label", "v", F.size("v").alias("dim")).join(small_side(sizes), ["label", "dim"])
                   .where(draw < rate).select("label", "v"))
    filled = some.mapInArrow(_trial_task(distance, choices, seed), "label long, dim int, choice int, key binary")
    met = (filled.groupBy("label", "dim", "choice", "key").agg(F.count(F.lit(1)).cast("double").alias("c"))
                 .groupBy("label", "dim", "choice").agg(F.sum(F.col("c") * (F.col("c") - 1)).alias("met")))
    pairs = F.col("met") / (rate * rate)
    passes = F.element_at(F.array(*[F.lit(p) for _, _, p in choices]), F.col("choice") + 1)
    cost = passes * (row_cost * (F.col("n") * 2 + pairs / window) + F.col("n") * window + pairs / 2)
    best = (met.join(small_side(sizes), ["label", "dim"]).withColumn("cost", cost)
               .groupBy("label", "dim").agg(F.min_by("choice", F.struct("cost", "choice")).alias("choice")))
    # a label of which the sample took nothing has few rows
    return stored(sizes.select("label", "dim").join(best, ["label", "dim"], "left")
                       .select("label", "dim", F.coalesce("choice", F.lit(0)).alias("choice")), "label-plan")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, window: int = WINDOW, recall: float = RECALL,
                    seed: int = 29, row_cost: float = ROW_COST) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links,
    component_id, kept."""
    prepare(vectors.sparkSession)
    usable = ("vec_id is not null and label is not null and embedding is not null "
              "and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
              "and exists(embedding, x -> x <> 0)")
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), F.col("label").cast("long"))
    good = rows.withColumn("_ok", F.coalesce(F.expr(usable), F.lit(False)))
    hashed = good.where("_ok").select("vec_id", "label", "embedding", F.xxhash64("label", "embedding").alias("h1"),
                                      F.xxhash64("embedding", F.lit(seed), "label").alias("h2"))
    classes = stored(hashed.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("c"),
                                                   F.first("label").alias("label"), F.first("embedding").alias("v")), "vector-classes")
    distance, choices = sqrt(max(2 - 2 * threshold, 1e-12)), _choices(recall)
    plan = _plan(classes, distance, choices, window, row_cost, seed)
    planned = (classes.select("rep", "label", "v", F.size("v").alias("dim")).join(small_side(plan), ["label", "dim"])
                      .select("rep", "label", "v", "choice"))
    keys = stored(planned.mapInArrow(_key_task(distance, choices, seed), "rep long, label long, dim int, pass int, key binary"), "vector-keys")
    order = ["label", "dim", "pass", "key", "rep"]
    ranked = surrogate_key(keys, order, "rank", materialize=True).join(classes.select("rep", "v"), "rep")
    block = F.expr(f"(rank - 1) div {window}")
    near = (ranked.select("label", "dim", "pass", "rank", "rep", "v", F.explode(F.array(block, block - 1)).alias("block")).where("block >= 0")
                  .groupBy("block").applyInPandas(_window_task(threshold, window), "a long, b long"))
    # runs of equal hashes that are longer than the window
    run = ["label", "dim", "pass", "key"]
    long_runs = stored(keys.groupBy(*run).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > window), "long-runs")
    nb = F.ceil(F.col("n") / window)
    member = (keys.join(small_side(long_runs), run).withColumn("nb", nb)
                  .withColumn("blk", F.pmod(F.xxhash64("rep"), F.col("nb")))
                  .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
                  .select(*run, "rep", "blk", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j")))
    within = (member.join(classes.select("rep", "v"), "rep").groupBy(*run, "i", "j")
                    .applyInPandas(_run_task(threshold), "a long, b long"))
    pairs = near.unionByName(within)
    parts = connected_components(stored(pairs.distinct(), "vector-pairs"))
    parts = stored(parts, "vector-parts")

    size = parts.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / COUNT_ROWS).alias("nb"))
    blocks = (classes.join(parts.withColumnRenamed("node", "rep"), "rep").join(size, "component")
                     .withColumn("blk", F.pmod(F.xxhash64("rep"), F.col("nb")))
                     .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
                     .select("component", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"),
                             "blk", "rep", "c", "v"))
    links = (blocks.groupBy("component", "i", "j").applyInPandas(_count_task(threshold), "rep long, links long")
                   .groupBy("rep").agg(F.sum("links").alias("links")))
    facts = stored(classes.select("h1", "h2", "rep", "c").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
                          .join(links, "rep", "left"), "vector-facts")
    found = hashed.select("vec_id", "h1", "h2").join(small_side(facts), ["h1", "h2"]).select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("c") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    alone = good.where("not _ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
