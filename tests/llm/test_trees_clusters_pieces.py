"""Merkle manifest, centroid clustering and sentencepiece ids against brute force and the library; edge cases of each."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from harvestline.llm import clustering, common, merkle, pieces, queries

from .test_llm import DOCS, EDGE, SF

CLASH = ("tree", "n", "block", "rank", "place", "node", "id", "uid", "x", "ids", "agrees", "cluster", "distance", "norm", "dots")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(EDGE, DOCS).withColumns({c: F.lit(7) for c in CLASH})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*(row[c] for c in merkle.FIELDS[:-1]), text)))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def brute_proofs(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"]), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    members = {s: sorted(groups[s], key=lambda p: p[:3]) for s in order}
    trees = {s: levels_of([p[2] for p in members[s]]) for s in order}
    top = levels_of([trees[s][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for i, (_, _, leaf, r) in enumerate(members[s]):
            path = []
            for levels, at in ((trees[s], i), (top, place)):
                for level in levels[:-1]:
                    first = at // 16 * 16
                    run = level[first:first + 16]
                    path.append(("".join(run[:at - first]), "".join(run[at - first + 1:])))
                    at //= 16
            text, folded = r["text"], leaf
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and text is not None:
                folded = leaf_of(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
            for left, right in path:
                folded = sha(left + folded + right)
            root = top[-1][0]
            out.append((r["doc_id"], leaf, trees[s][-1][0], root, sha("".join(a + b for a, b in path)), folded, folded == root))
    return sorted(out, key=repr)


def proofs_of(docs):
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = merkle.proofs(merkle.build(docs, F.when(tampered, merkle.row_digest(text=lowered))))
    return sorted(map(tuple, found.collect()), key=repr)


def test_van_emde_boas_places():
    for height in range(1, 5):
        places = np.concatenate([merkle.address(d, np.arange(16 ** d), height) for d in range(height)])
        assert sorted(places) == list(range(merkle.tree_size(height)))
    # the lower half of four levels: a parent and its 16 children lie side by side
    assert merkle.address(2, np.arange(2), 4).tolist() == [17, 34]
    assert merkle.address(3, np.arange(17), 4).tolist() == [*range(18, 34), 35]


def test_manifest_of_edge_rows(spark, docs):
    assert proofs_of(docs) == brute_proofs(docs.collect())
    assert proofs_of(docs.limit(0)) == [] and merkle.build(docs.limit(0)).root() is None


def test_manifest_over_several_tiers(spark):
    """A hot source of more than one block, repeated and null ids, one equal row many times, many sources."""
    rows = [(None if i % 7 == 0 else i // 2, "en", "hot" if i % 3 else None if i % 2 else f"s{i % 301}", i, f"Text {i}") for i in range(14000)]
    rows += [(5, "en", "hot", 1, "Equal")] * 3000 + [(7, "en", "é", 1, "A"), (7, "en", "z", 1, "A"), (7, "en", "", 1, "A")]
    many = spark.createDataFrame(rows, "doc_id long, lang string, source string, n_chars long, text string")
    assert proofs_of(many) == brute_proofs(many.collect())


def test_manifest_with_paths_joined_by_shuffle(spark, docs, monkeypatch):
    monkeypatch.setattr(merkle, "bounded_side", lambda df: common.bounded_side(df, 0))
    assert proofs_of(docs) == brute_proofs(docs.collect())


def test_lone_row_is_the_root(spark):
    one = spark.createDataFrame([(3, None, "en", None, None)], DOCS)
    ((_, leaf, subroot, root, proof, folded, verified),) = proofs_of(one)
    assert leaf == subroot == root == folded and verified and proof == sha("")


def brute_clusters(vectors, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * float(c)) for c in v]) for i, v in vectors
            if v is not None and len(v) == 64 and all(c is not None and math.isfinite(c) for c in v)]
    start = sorted(kept, key=lambda p: (p[0] is None, sha(f"3:{p[0]}"), p[1]))[:k]
    centroids = [list(x) for _, x in start]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids)) for _, x in kept]

    for _ in range(rounds):
        near = assign()
        for n in range(len(centroids)):
            mine = [x for (_, x), (_, m) in zip(kept, near) if m == n]
            if mine:
                centroids[n] = [sum(c) // len(mine) for c in zip(*mine)]
    near = assign()
    total = sum(d for d, _ in near)
    inertia = [sum(d for d, m in near if m == n) for n in range(len(centroids))]
    return sorted(((i, n, d, inertia[n], total, sha(",".join(map(str, centroids[n])))) for (i, _), (d, n) in zip(kept, near)), key=repr)


def clusters_of(spark, rows, **kw):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(7) for c in CLASH})
    return sorted(map(tuple, clustering.report(*clustering.cluster(vectors, **kw)).collect()), key=repr)


def test_clusters_of_the_table_and_of_edge_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    rows += [(None, rows[0][1]), (None, rows[1][1]), *rows[:5], (-1, None), (-2, []), (-3, [0.5] * 63), (-4, [0.5] * 65), (-5, [0.1] * 63 + [None]),
             (-6, [0.1] * 63 + [float("nan")]), (-7, [0.1] * 63 + [float("-inf")]), (-8, [0.0] * 64), (-9, [-1e-9] * 64), (-10, [0.1] * 100_000)]
    assert clusters_of(spark, rows) == brute_clusters(rows)
    assert clusters_of(spark, []) == []
    assert clusters_of(spark, rows[:3]) == brute_clusters(rows[:3])


def test_clusters_of_ties_and_equal_vectors(spark):
    """Equal vectors start several equal centroids: the smaller number takes all, the others stay empty."""
    rows = [(i, [float(i // 20)] * 64) for i in range(60)]
    found = clusters_of(spark, rows)
    assert found == brute_clusters(rows)
    assert len({r[1] for r in found}) < 8


def test_clusters_leave_out_what_no_long_holds(spark):
    assert clusters_of(spark, [(1, [0.5] * 64), (2, [3e38] * 64)]) == brute_clusters([(1, [0.5] * 64)])


def test_dot_products_stay_exact_over_moves():
    rng = np.random.default_rng(1)
    x = rng.integers(-1024, 1024, (50, 64))
    before, now = rng.integers(-1024, 1024, (2, 8, 64))
    now[:, ::3] = before[:, ::3]
    import pyarrow as pa
    ends = np.arange(51, dtype=np.int32)
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.ListArray.from_arrays(ends * 64, pa.array(x.ravel()))], ["id", "x"])
    (first,) = clustering._move_task(64, np.zeros_like(before), before)(iter([batch]))
    (second,) = clustering._move_task(64, before, now)(iter([first]))
    assert (np.array(second.column("dots").to_pylist()) == x @ now.T).all()
    assert second.column("distance").to_pylist() == ((x[:, None] - now) ** 2).sum(axis=2).min(axis=1).tolist()


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(public_tokenizers.path("piece_bpe_32k.model"))


def ids_of(model, text):
    ids, agrees = model.encode(text)
    assert agrees
    return ids.tolist()


def test_pieces_equal_the_library(model):
    rng = random.Random(1)
    pool = [chr(c) for c in range(128)] * 3 + list("▁▁▁    ​　é́一😀\U0010ffff�²²½१") + list(model.ids)[:4000]
    for _ in range(1500):
        text = "".join(rng.choices(pool, k=rng.randint(0, 60)))
        assert ids_of(model, text) == model.library.encode(text), text
    for text in ("", " ", "   ", "<s>", "</s><unk><0x0A>", "\x00", "a" * 20_000, " " * 20_000, "ab\r\n" * 5000, "²." * 50, "a².b"):
        assert ids_of(model, text) == model.library.encode(text)


def test_pieces_in_slices_and_with_few_parts_remembered(model, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_PARTS", 2)
    monkeypatch.setattr(pieces, "SLICE_CHARS", 7)
    text = "the quick brown fox,   the quick brown dog. " * 5 + "x" * 100
    small = pieces.PieceModel(public_tokenizers.path("piece_bpe_32k.model"))
    assert ids_of(small, text) == model.library.encode(text) and len(small.known.now) <= 4


@pytest.mark.parametrize("letters", [r"(?!)", None])
def test_coarser_cuts_give_the_same_ids(model, letters):
    """Cuts at blanks only, and none: the agenda runs over all of a text."""
    other = pieces.PieceModel(public_tokenizers.path("piece_bpe_32k.model"))
    if letters:
        other.parts, other.letter = re.compile("▁*(?:(?!)+|(?:(?!(?!))[^▁])+)|▁+"), re.compile(letters)
    else:
        other.parts, other.alone, other.checked = re.compile(r"(?s:.+)"), False, False
    text = "Une  phrase avec des  blancs,\net 12 chiffres. " * 20
    assert ids_of(other, text) == model.library.encode(text)


def test_both_kinds_of_agenda_merge_alike(model):
    rng = random.Random(2)
    for _ in range(300):
        part = "▁" + "".join(rng.choices("abeinrst", k=rng.randint(0, 60)))
        assert model._merge_few(list(part)) == model._merge_many(list(part))


def test_a_difference_from_the_library_shows(monkeypatch):
    model = pieces.PieceModel(public_tokenizers.path("piece_bpe_32k.model"))
    real = model.part_ids
    monkeypatch.setattr(model, "part_ids", lambda part: real(part) if part != "▁word" else real("▁wor"))
    assert [model.encode(t)[1] for t in ("a text", "a word", "a text", "word")] == [True, False, True, False]


def test_encoding_and_decoding_of_edge_rows(spark, docs, model):
    path = public_tokenizers.path("piece_bpe_32k.model")
    found = pieces.decode(pieces.encode(docs, path), path).collect()
    assert len(found) == len(EDGE) and all(r["agrees"] for r in found)
    expect = sorted(((r[0], model.library.encode(r[1] or "")) for r in EDGE), key=repr)
    assert sorted(((r["doc_id"], r["ids"]) for r in found), key=repr) == expect
    assert sorted(r["text"] for r in found) == sorted(model.library.decode(ids) for _, ids in expect)
    assert sorted(map(str, pieces.round_trip(docs, path).collect())) == sorted(map(str, found))
    null = spark.createDataFrame([(1, None, True)], "doc_id long, ids array<int>, agrees boolean")
    assert pieces.decode(null, path).first()["text"] == ""
    assert pieces.decode(pieces.encode(docs.limit(0), path), path).collect() == []


def test_sentencepiece_query_against_the_library(spark, model):
    found = {r["doc_id"]: tuple(r)[1:] for r in queries.op13_sentencepiece(spark, SF).collect()}
    expect = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = model.library.encode(r["text"] or "")
        expect[r["doc_id"]] = (len(ids), sha(",".join(map(str, ids))), sha(model.library.decode(ids)), True)
    assert found == expect


def test_other_models_are_refused(monkeypatch):
    monkeypatch.setattr(pieces, "_BPE", 1)
    with pytest.raises(ValueError):
        pieces.PieceModel(public_tokenizers.path("piece_bpe_32k.model"))
