"""Corpus operators against brute force, round trips and held-out accuracy; edge cases of each."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from harvestline.llm import (
    bitpack,
    embed_dedup,
    html_extract,
    kernels,
    mixing,
    ngram_join,
    packing,
    pii,
    quality_model,
    quality_rules,
    queries,
    token_counts,
)

SF = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet " * 20000
EDGE = [
    (1, "one two three four five six seven", "en", "a", 5), (1, "another text of the same id here", "en", "a", 5),
    (2, "one two three four five six seven", "en", None, None), (3, None, None, "a", 0), (4, "", "en", "b", 0),
    (5, " \n\t ", "en", "b", 4), (None, "a text without an id", "en", "b", 9), (6, LONG, "en", "c", len(LONG)),
    (7, "a b c", "en", "c", 5), (8, "A b C", "en", "c", 5), (9, "word", "en", "c", 4), (9, "word", "en", "c", 4),
]


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns that clash with names used inside and with outputs
    return spark.createDataFrame(EDGE, DOCS).withColumns({c: F.lit(7) for c in ("id", "n", "key", "_row", "_t", "score", "size", "start")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def components(nodes, links):
    part = {n: n for n in nodes}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        part[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_word_and_shingle_hashes_across_segments(monkeypatch):
    text = " ".join(f"w{i % 37}" for i in range(400)).encode()
    data, off = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    whole = list(kernels.shingle_sets(data, off, 5))[0]
    monkeypatch.setattr(kernels, "SEGMENT", 64)
    monkeypatch.setattr(kernels, "_cache", {})
    assert np.array_equal(list(kernels.shingle_sets(data, off, 5))[0], whole)
    assert len(whole) == len(shingles(text.decode()))


# 1 mixing

def test_mixing_meets_targets_and_repeats(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    m = mixing.mix(d).toPandas()
    again = mixing.mix(d.repartition(7)).toPandas()
    key = ["doc_id", "taken"]
    assert m[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()
    assert (m.taken <= 2 * m["size"]).all() and len(m) == d.count()
    by = m.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), size=("size", "sum"), mx=("size", "max"))
    assert ((by.taken - by.target).abs() <= by.mx / 2 + 1).all()
    assert abs(by.target.sum() - 1.5 * by["size"].sum()) < 1e-6 * by["size"].sum()
    # water filling by hand
    weights, left, total = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(by.index))}, set(by.index), 1.5 * by["size"].sum()
    target = {}
    while True:
        share = (total - sum(target.values())) / sum(weights[s] for s in left)
        over = [s for s in left if share * weights[s] >= 2 * by["size"][s]]
        if not over:
            break
        for s in over:
            target[s] = 2 * by["size"][s]
            left.discard(s)
    target |= {s: share * weights[s] for s in left}
    assert all(abs(target[s] - by.target[s]) < 1e-6 * target[s] for s in target)


def test_pivotal_rounding_keeps_mass_and_expectation():
    rng = np.random.default_rng(3)
    size, p = rng.integers(1, 50, 40), rng.uniform(0, 1, 40)
    sums = np.zeros(40)
    for seed in range(1500):
        out = mixing.round_block(size, p, np.arange(40), seed)
        assert ((out > 0) & (out < 1)).sum() <= 1 and abs((out - p) @ size) < 1e-6
        sums += out
    assert np.abs(sums / 1500 - p).max() < 0.08


def test_mixing_blocks_and_edges(spark, docs, empty):
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('x ', cast(1 + id % 40 as int))").alias("text"),
                                    F.expr("if(id % 3 = 0, 'hot', concat('s', id % 5))").alias("source"))
    m = mixing.mix(many, block_rows=16).toPandas()
    by = m.groupby("source").agg(t=("target", "first"), k=("taken", "sum"), mx=("size", "max"))
    assert ((by.t - by.k).abs() <= by.mx).all() and len(m) == 3000
    assert mixing.mix(empty).count() == 0
    plan = mixing.mix(docs)
    assert plan.count() == len(EDGE)
    taken = mixing.take(docs, plan)
    assert taken.columns == docs.columns and taken.count() == plan.agg(F.sum("copies")).first()[0]


def test_mixing_spreads_a_repeated_id_over_blocks(spark, monkeypatch):
    task = mixing._round_task

    def watched(seed):
        run = task(seed)

        def with_rows(pdf):
            return run(pdf).assign(whole=len(pdf))
        return with_rows

    many = spark.range(3000).select(
        F.expr("if(id % 3 = 0, null, if(id % 3 = 1, 7, id))").alias("doc_id"), F.expr("repeat('x ', cast(1 + id % 40 as int))").alias("text"),
        F.lit("s").alias("source"), F.col("id").alias("n_chars"))
    many = many.unionByName(many.limit(1).withColumn("source", F.lit("t")))
    plan = mixing.mix(many, block_rows=100)
    again = mixing.mix(many.repartition(7), block_rows=100)
    key = ["doc_id", "size", "source", "copies"]
    assert sorted(map(str, plan.select(key).collect())) == sorted(map(str, again.select(key).collect()))
    taken = mixing.take(many, plan)
    want = {(r.doc_id, r.size, r.source): r.c for r in plan.groupBy("doc_id", "size", "source").agg(F.sum("copies").alias("c")).collect() if r.c}
    size = F.regexp_count("text", F.lit("x")).alias("size")
    assert {(r.doc_id, r.size, r.source): r["count"] for r in taken.groupBy("doc_id", size, "source").count().collect()} == want
    assert taken.groupBy("n_chars", "source").count().agg(F.max("count")).first()[0] <= 2
    # no block is much larger than block_rows
    monkeypatch.setattr(mixing, "_round_task", watched)
    largest = mixing.mix(many, weights=(1, 1), budget=1.2, block_rows=100).agg(F.max("copies")).first()[0]
    assert 50 < largest < 300


# 2 token counts

def test_token_counts_against_plain_viterbi(spark, docs, empty):
    rnd = random.Random(0)
    scores = {"".join(rnd.choice("abé" + token_counts.MARK) for _ in range(rnd.randint(1, 4))): -9 * rnd.random() for _ in range(60)}

    def plain(word):
        word, best = token_counts.MARK + word, [(0.0, 0)]
        for end in range(1, len(word) + 1):
            n = len(word[end - 1].encode())
            options = [(best[end - 1][0] - token_counts.BYTE_SCORE * n, best[end - 1][1] + n)]
            options += [(best[s][0] - scores[word[s:end]], best[s][1] + 1) for s in range(end) if word[s:end] in scores]
            best.append(min(options))
        return best[-1][1]

    words = list({"".join(rnd.choice("abécx") for _ in range(rnd.randint(1, 12))) for _ in range(1500)})
    assert token_counts.count_words(words, token_counts.Pieces(scores)) == [plain(w) for w in words]
    import public_tokenizers
    path = public_tokenizers.path("piece_bpe_32k.model")
    r = token_counts.token_counts(docs, path).toPandas()
    assert len(r) == len(EDGE) and r.n_tokens[r.n_words == 0].sum() == 0 and (r.n_tokens >= r.n_words).all()
    assert token_counts.token_counts(empty, path).count() == 0


# 3 packing

def check_packing(pieces, tokens):
    q = pieces.sort_values(["sequence_id", "offset"])
    assert (q.offset == q.groupby("sequence_id").length.cumsum() - q.length).all()
    used = q.groupby("sequence_id").length.sum()
    assert used.max() <= 2048 and ((used & (used - 1)) == 0).all() and used.sum() == tokens


def test_packing_against_the_tokenizer(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.word_vocabulary())
    d = spark.read.parquet(f"{SF}/documents.parquet")
    p = packing.pack(d, queries.word_vocabulary()).toPandas()
    tokens = 0
    texts = {r.doc_id: r.text for r in d.collect()}
    for i, g in p.sort_values(["doc_id", "start"]).groupby("doc_id"):
        ids = np.array(tok.encode(texts[i] or "", add_special_tokens=False).ids + [1], "<u4")
        assert (g.start.to_numpy() == g.length.cumsum().to_numpy() - g.length.to_numpy()).all() and g.length.sum() == len(ids)
        assert all(zlib.crc32(ids[s:s + n].tobytes()) == c for s, n, c in zip(g.start, g.length, g.ids_crc32))
        tokens += len(ids)
    check_packing(p, tokens)
    assert set(p.doc_id) == set(texts)


def test_packing_edges(spark, docs, empty):
    p = packing.pack(docs, queries.word_vocabulary(), with_ids=True).toPandas()
    check_packing(p, p.length.sum())
    assert (p.ids.map(len) == 4 * p.length).all() and p.doc_id.isna().any()
    assert packing.pack(empty, queries.word_vocabulary()).count() == 0
    assert packing.piece_lengths(5000) == [2048, 2048, 512, 256, 128, 8]


def test_packing_keeps_rests_whole(spark):
    """Under two pieces a document beyond its full sequences, few sequences that are not full."""
    p = packing.pack(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), queries.word_vocabulary()).toPandas()
    rests = p[p.start >= p.doc_tokens // 2048 * 2048].groupby("doc_id").size()
    assert rests.mean() < 1.6 and rests.max() <= 11
    used = p.groupby("sequence_id").length.agg(["sum", "size"])
    assert (used["sum"] < 2048).sum() <= 11 and (p.length == 1).sum() <= 5 and len(p) < 1.6 * p.doc_id.nunique()


def test_packing_many_equal_rows(spark):
    """A hundred thousand equal rows are many groups of a bounded size."""
    d = spark.range(100_000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("one two three " * 7).alias("text"))
    p = packing.pack(d, queries.word_vocabulary())
    per_group = [r["n"] for r in p.groupBy(F.shiftright("sequence_id", 22)).agg(F.sum("length").alias("n")).collect()]
    assert len(per_group) > 4 and max(per_group) < 2 * 2048 * packing.GROUP_BINS
    check_packing(p.toPandas(), 100_000 * 22)


def test_bins_hold_a_fixed_count_of_whole_rests():
    rng = random.Random(6)
    for _ in range(300):
        k = rng.choice([1, 2, 3, 7, packing.LAST_CLASS])
        low, high = (2048 // (k + 1) + 1, min(2047, 2048 // k)) if k < packing.LAST_CLASS else (1, 32)
        lengths = [rng.randint(low, high) for _ in range(rng.randint(0, 80))]
        bins, left = packing.fill_bins(lengths, k)
        covered = {}
        for i, first, n in sorted(x for b in [*bins, left] for x in b):
            assert first == covered.get(i, 0) and n > 0
            covered[i] = first + n
        assert [covered[i] for i in range(len(lengths))] == lengths
        assert all(sum(n for *_, n in b) == 2048 for b in bins) and sum(n for *_, n in left) < 2048
        if k < packing.LAST_CLASS:
            assert all(sum(first == 0 and n == lengths[i] for i, first, n in b) >= k - 1 for b in bins)


# 4 HTML

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p><p>no";</script></head>
<body class="with-sidebar"><header>no</header><nav><ul><li><a href="/x">no</a></li></ul></nav><div class="cookie-notice">no</div>
<div class="col-12 content"><article id="post-7"><h1>Title &amp; more</h1><p>First  <b>bold</b>\n text &#233;&nbsp;x<br>next.<p>Second, longer paragraph
with words in it.<!-- no --><div class="ad">no</div><form>no<input></form><ul><li>item one<li>item two</ul><table><tr><td>cell</table>
<section class="comments"><p>reader says no</p></section></article></div><aside>no</aside><footer>no</footer>"""


def test_html_main_text_and_consensus(spark):
    blocks = ["Title & more", "First bold text é x next.", "Second, longer paragraph with words in it.", "item one", "item two", "cell"]
    assert html_extract.main_text(PAGE, None) == "\n\n".join(blocks)
    odd = PAGE.replace("<article", "<div class=promo-x><p>" + "a longer piece of teaser text " * 30 + "</p></div><article")
    rows = [(i, "http://h.example/a", PAGE) for i in range(5)] + [(9, "http://H.example/b", odd), (10, None, None), (11, "x", ""), (12, "y", "<p>a<b"), (12, "y", "plain")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit(1)).withColumn("host", F.lit(2))
    got = {(r.page_id, r.text) for r in html_extract.extract(pages).collect()}
    assert (0, "\n\n".join(blocks)) in got and (9, "\n\n".join(blocks)) in got
    assert (10, "") in got and (11, "") in got and (12, "a") in got and (12, "plain") in got
    assert html_extract.extract(pages.limit(0)).count() == 0


LONG_P = "<p>" + "words of the body text " * 40 + "</p>"


@pytest.mark.parametrize("page, parts", [
    (f"<article><h1>Title</h1><p>Lede</p><div class=body>{LONG_P}</div></article>", ["Title", "Lede", "words"]),
    (f"<div class=post><h1>Title</h1><div class=inner><div class=body>{LONG_P}</div></div><p>After</p></div>", ["Title", "words", "After"]),
    (f"<article><section class=a>{LONG_P}</section><section class=b><p>Second</p></section><section class=c><p>Third</p></section></article>",
     ["words", "Second", "Third"]),
    (f"<article><p>Before</p><blockquote>{LONG_P}</blockquote><p>After</p></article>", ["Before", "words", "After"]),
    (f"<article><p>Before</p><table><tr><td>{LONG_P}<td>Cell</table></article>", ["Before", "words", "Cell"]),
    (f"<main><h1>Title</h1><article>{LONG_P}</article></main>", ["Title", "words"]),
    (f"<div class=all><div class=x><a href=/a>link text</a> of</div><div class=body>{LONG_P}</div></div>", ["words"]),
])
def test_html_climbs_from_a_part_to_the_whole(page, parts):
    def firsts(text):
        return [block.split(" ")[0] for block in text.split("\n\n")]

    assert firsts(html_extract.main_text(f"<body>{page}</body>", None)) == parts
    # also where the host's path is the part
    inner = html_extract.parse(f"<body>{page}</body>")
    best = max(inner.nodes, key=lambda n: n.score).path
    assert firsts(html_extract.main_text(f"<body>{page}</body>", best)) == parts


@pytest.mark.parametrize("piece, kept", [
    ('<h2 id="related-work">PIECE</h2>', True), ('<h2 id="navigation">PIECE</h2>', True), ('<h3 id="social-effects">PIECE</h3>', True),
    ('<h1 class="page header">PIECE</h1>', True), ('<p id="notice">PIECE</p>', True), ('<p>a <span class="alert">PIECE</span></p>', True),
    ('<section id="legal-basis"><p>PIECE</p></section>', True), ('<section id="promotion-rules"><p>PIECE</p></section>', True),
    ('<section id="navigation"><p>PIECE</p></section>', True), ('<div class="related-work"><p>PIECE</p></div>', True),
    ('<div class="has-sidebar"><p>PIECE</p></div>', True), ('<div class="legal"><p>PIECE' + " long" * 300 + "</p></div>", True),
    ('<div class="entry-header"><h1>PIECE</h1></div>', True), ('<div class="post promo"><p>PIECE</p></div>', True),
    ('<div class="post-navigation">PIECE</div>', False), ('<div class="article-share">PIECE</div>', False),
    ('<div class="entry-related"><p>PIECE</p></div>', False), ('<div class="main-menu">PIECE</div>', False),
    ('<div class="related-posts">PIECE</div>', False), ('<ul class="social-icons-2"><li>PIECE</ul>', False),
    ('<div id="cookie-banner">PIECE</div>', False), ('<div id="comments"><p>PIECE' + " long" * 300 + "</p></div>", False),
    ('<div class="cookie-notice"><p>PIECE' + " long" * 300 + "</p></div>", False), ('<div class="commentBody"><p>PIECE</p></div>', False),
    ('<section id="navigation"><a href="/a">PIECE and more</a></section>', False), ('<p class="ad">PIECE</p>', False),
    ('<div class="legal"><a href="/a">PIECE' + " long" * 300 + "</a></div>", False), ('<span class="hidden">PIECE</span>', False),
])
def test_html_clutter_by_name(piece, kept):
    text = html_extract.main_text(f"<body><article><p>{'before ' * 50}</p>{piece}<p>after</p></article></body>", None)
    assert ("PIECE" in text) == kept and text.startswith("before") and text.endswith("after")


# 5 n-gram join

def test_ngram_join_against_brute_force(spark):
    rnd = random.Random(5)
    vocab = [f"v{i}" for i in range(400)]
    passage = [rnd.choice(vocab) for _ in range(30)]
    rows = []
    base = [rnd.choice(vocab) for _ in range(60)]
    for i in range(260):
        kind = i % 4
        words = [rnd.choice(vocab) for _ in range(rnd.randint(1, 40))] if kind else list(base)
        if kind == 0:  # one large group of near copies
            for _ in range(rnd.randint(0, 3)):
                words[rnd.randrange(len(words))] = rnd.choice(vocab)
        elif kind == 1:  # a passage that many share
            words = words[:12] + passage
        elif kind == 2 and rows:  # short near copies
            words = (rows[rnd.randrange(len(rows))][1] or "x").split()[:rnd.randint(5, 30)] + words[:1]
        rows.append((i, " ".join(words)))
    rows += [(1000, rows[0][1].upper()), (1001, None), (1002, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = components(sets, links)
    for options in ({}, {"list_rows": 2}, {"heavy_keys": 3, "list_rows": 4}):
        got = ngram_join.ngram_components(d, **options).collect()
        assert {r.doc_id: r.component_id for r in got} == want
        assert all(r.n_shingles == len(sets[r.doc_id]) for r in got)
    kept = {r.doc_id for r in ngram_join.keep_representatives(d).collect()}
    assert kept == set(want.values())


def test_ngram_join_edges(docs, empty):
    got = ngram_join.ngram_components(docs).collect()
    assert len(got) == len(EDGE)
    parts = {(r.doc_id, r.n_shingles): r.component_id for r in got}
    assert parts[(2, 3)] == 1 and parts[(8, 1)] == 7 and parts[(None, 1)] is None and parts[(3, 0)] == 3
    assert ngram_join.ngram_components(empty).count() == 0
    kept = ngram_join.keep_representatives(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7, 9]


def test_ngram_join_holds_no_rows_in_the_driver(spark, monkeypatch):
    """Frequent keys come as Arrow, and ids used once or for one text alone cost no joins."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic
    monkeypatch.setattr(Classic, "toPandas", lambda self: pytest.fail("rows of keys in the driver"))
    rows = [(i, f"the same five words here and {i} {i + 1} {i + 2} {i + 3} {i + 4}") for i in range(40)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert ngram_join.members(ngram_join.shingle_classes(d)) == (None, None)
    kept = ngram_join.keep_representatives(d, list_rows=2)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(40))
    twice = d.unionByName(d.where("doc_id < 3")).unionByName(d.where("doc_id = 7").withColumn("doc_id", F.lit(99).cast("long")))
    copies, repeated = ngram_join.members(ngram_join.shingle_classes(twice))
    assert [r.doc_id for r in copies.collect()] == [99] and sorted(r.doc_id for r in repeated.collect()) == [0, 1, 2]
    kept = ngram_join.keep_representatives(twice, list_rows=2)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(40))


# 6 bit packing

@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 20, 32])
def test_bit_packing_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 9, 1000):
        x = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
        data = bitpack.pack_bits(x, bits)
        assert len(data) == -(-n * bits // 8) and np.array_equal(bitpack.unpack_bits(data, n, bits), x)


def test_bit_packed_files(spark, docs, empty, scratch):
    from pyarrow import fs
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.word_vocabulary())
    d = spark.read.parquet(f"{SF}/documents.parquet")
    manifest = bitpack.write(d, queries.word_vocabulary(), scratch, block_ids=512, shard_bytes=50_000)
    r = bitpack.read_digests(manifest, scratch).toPandas().sort_values("doc_id")
    assert manifest.count() > 2 and (r.start == r.n_tokens.cumsum() - r.n_tokens).all()
    texts = {x.doc_id: x.text for x in d.collect()}
    ids = {i: np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in texts.items()}
    assert [zlib.crc32(ids[i].tobytes()) for i in r.doc_id] == list(r.ids_crc32)
    with fs.LocalFileSystem().open_input_file(manifest.first().path) as f:  # random access
        shard = bitpack.ShardReader(f)
        for k in (len(shard.docs) - 1, 0, len(shard.docs) // 2):
            assert np.array_equal(shard.document(k), ids[int(shard.docs[k])])
            first, last = (int(shard.ends[k - 1]) if k else 0), int(shard.ends[k])
            assert np.array_equal(shard.ids(first + 1, last), ids[int(shard.docs[k])][1:]) and len(shard.ids(first, first)) == 0
        assert len(shard.blocks) == -(-shard.n_ids // 512) and (np.diff(shard.blocks) == 512 * shard.bits // 8).all()
    e = bitpack.round_trip(docs, queries.word_vocabulary()).toPandas()
    assert len(e) == len(EDGE) and e.doc_id.isna().sum() == 1
    assert bitpack.round_trip(empty, queries.word_vocabulary()).count() == 0


def test_bit_packed_files_of_a_hot_id(spark, scratch):
    """Half of the rows have no id, a third share one; they fill many shards. The least id is an id."""
    d = spark.range(6000).select(F.when(F.col("id") % 2 == 0, None).when(F.col("id") % 3 == 0, F.lit(-(1 << 63))).otherwise(F.col("id")).alias("doc_id"),
                                 F.concat(F.lit("word " * 20), (F.col("id") % 100).cast("string")).alias("text"))
    manifest = bitpack.write(d, queries.word_vocabulary(), scratch, shard_bytes=20_000)
    sizes = [r.documents for r in manifest.collect()]
    assert len(sizes) > 20 and max(sizes) < 6000 / 8
    r = bitpack.read_digests(manifest, scratch)
    assert r.where("doc_id is null").count() == 3000 and r.where(f"doc_id = {-(1 << 63)}").count() == 1000
    p = r.orderBy("start").toPandas()
    assert (p.start == p.n_tokens.cumsum() - p.n_tokens).all()
    assert p.doc_id.isna().to_numpy()[:3000].all()


# 7 personal data

def plain_spans(t):
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in re.sub("[^0-9]", "", m[0])][::-1]
        if 16 <= len(d) <= 19 and sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0:
            out.append(("card", m))
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in out)


def test_pii_against_plain_patterns(spark, docs, empty):
    rnd = random.Random(2)
    bits = ["a@b.c", "_x@d.e", "@", ".", "1.2.3.4", "999.1.1.1", "4111 1111 1111 1111", "4111111111111111", "-", " ", "+1 (2) 345-6789", "+", "é", "😀", "12", "..", "(", "x"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14))) for _ in range(800)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = pii.with_spans(d).select("doc_id", pii.joined(F.col("pii_spans")).alias("s")).collect()
    assert [(texts[r.doc_id], r.s) for r in got if r.s != plain_spans(texts[r.doc_id])] == []
    one = spark.createDataFrame([(1, "iban DE89 3704 0044 0532 0130 00, DE88370400440532013000, call +1 234 567 890; 9" + "9" * 30000)], "doc_id long, text string")
    r = pii.redact(pii.with_spans(one)).first().text
    assert r.startswith("iban <IBAN>, DE88370400440532013000, call <PHONE>; 99")
    e = pii.with_spans(docs.withColumn("pii_spans", F.lit(1)))
    assert e.count() == len(EDGE) and set(pii.redact(e).columns) == set(docs.columns) and pii.with_spans(empty).count() == 0


def test_pii_context_decides(spark):
    texts = ["my account no. 12345678, thanks", "order no. 12345678, thanks", "Konto: 1234567890", "account " + "x" * 60 + " 12345678",
             "account 1234567", "account 12345678.50"]
    got = [r.s for r in pii.with_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
           .orderBy("doc_id").select(pii.joined(F.col("pii_spans")).alias("s")).collect()]
    assert got == ["account:15:23", "", "account:7:17", "", "", ""]


# 8 rules

def test_rule_ledger(spark, docs, empty):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(["a ", "b ", "c# ", "\n", "a b c ", "  ", "é\t", "|"]) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality_rules.ledger(d).collect():
        t = texts[r.doc_id]
        words, at = re.findall(WORD, t), {}
        for i in range(len(words) - 2):
            at.setdefault(tuple(words[i:i + 3]), []).append(i)
        lines = [x for x in t.split("\n") if re.search(WORD, x)]
        want = (len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)),
                len({p + k for v in at.values() if len(v) > 1 for p in v for k in range(3)}))
        assert tuple(r[m] for m in quality_rules.MEASURES) == want
        assert bool(r.failed & 1) == (want[0] < 50) and bool(r.failed & 2) == (100 * want[5] > 50 * want[0])
    book = quality_rules.ledger(d).toPandas()
    for r in quality_rules.ablation(quality_rules.ledger(d)).collect():
        bit = quality_rules.BIT[r.rule]
        assert r.removed_alone == (book.failed == bit).sum() and r.failed == (book.failed & bit > 0).sum()
    assert quality_rules.ledger(docs).count() == len(EDGE) and quality_rules.ledger(empty).count() == 0


def test_html_deep_and_unclosed_pages():
    """Memory grows with the length of a page, not with its depth; end tags without a start cost nothing."""
    import time
    import tracemalloc
    deep = "<article>" + "<div class='x'>" * 50_000 + "<p>deep text</p>" + "</div>" * 50_000 + "</article>"
    tracemalloc.start()
    assert html_extract.main_text(deep, None) == "deep text"
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()
    began = time.process_time()
    stray = "<article><p>" + "<b>" * 20_000 + "</i>" * 20_000 + "kept" + "<div></div>" * 2000 + "</article>"
    assert "kept" in html_extract.main_text(stray, None)
    assert time.process_time() - began < 5


@pytest.mark.parametrize("name", ["adsbygoogle", "taboola", "outbrain-widget", "kommentare", "werbung", "publicidad", "user-reviews", "gdpr"])
def test_html_adverts_by_other_names(name):
    page = f"<article><h1>Title</h1><p>{'Some words of the text. ' * 20}</p><div class='{name}'>{'Not a part of it. ' * 5}</div></article>"
    assert "Not a part" not in html_extract.main_text(page, None)


# 9 embeddings

def test_embedding_components_and_links(spark):
    rng = np.random.default_rng(9)
    rows, n = [], 0
    for label in (0, 1):
        for _ in range(60):
            v = rng.standard_normal(16)
            for _ in range(int(rng.integers(1, 4))):
                rows.append((n, (v + rng.standard_normal(16) * 0.03 * np.linalg.norm(v) / 4).tolist(), label))
                n += 1
    v = rng.standard_normal(16)
    for _ in range(150):  # one group wider than the window
        rows.append((n, (v + rng.standard_normal(16) * 0.02).tolist(), 1))
        n += 1
    rows += [(n + i, rows[3][1], rows[3][2]) for i in range(40)]
    n += 40
    bad = [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [float("nan")] + [1.0] * 15, 1), (n + 3, rows[3][1], None), (None, rows[3][1], 0),
           (n + 4, [], 1), (n + 5, [None] * 16, 1), (n + 6, rows[3][1][:8], 0)]
    d = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit(1))
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.98) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows])[None])
    np.fill_diagonal(near, False)
    want = components(range(n), [(int(a), int(b)) for a, b in zip(*np.where(near))])
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(d, window=8).collect()}
    assert len(got) == len(rows) + len(bad)
    assert all(got[i].component_id == want[i] and got[i].n_links == near[i].sum() and got[i].kept == (want[i] == i) for i in range(n))
    assert all(got[b[0]].n_links == 0 and got[b[0]].component_id == b[0] for b in bad)
    assert embed_dedup.near_duplicates(d.limit(0)).count() == 0


@pytest.mark.parametrize("row_cost", [embed_dedup.ROW_COST, 20])
def test_embedding_pairs_under_a_common_mean(spark, row_cost):
    # a dense cone (mean cosine 0.9) that holds isolated pairs just above the threshold
    rng = np.random.default_rng(4)
    n, dim = 3000, 64
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    mean = unit(rng.standard_normal(dim))
    x = unit(mean + unit(rng.standard_normal((n, dim))) / 3)
    side = rng.standard_normal((300, dim))
    side = unit(side - (side * x[:300]).sum(1, keepdims=True) * x[:300])
    x = np.concatenate((x, 0.981 * x[:300] + np.sqrt(1 - 0.981 ** 2) * side))
    near = x @ x.T >= 0.98
    np.fill_diagonal(near, False)
    want = components(range(len(x)), [(int(a), int(b)) for a, b in zip(*np.where(near))])
    d = spark.createDataFrame(pd.DataFrame({"vec_id": range(len(x)), "embedding": x.tolist(), "label": 3}))
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(d, row_cost=row_cost).collect()}
    assert all(got[i].component_id == want[i] and got[i].n_links == near[i].sum() for i in range(len(x)))


# 10 classifier

def test_classifier_on_held_out_rows(spark, docs, empty):
    sf = "/root/testdata/sf0.01"
    out = queries.op10_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    held = out[out.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.95 and out.score.between(0, 1).all()
    d, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet").withColumnRenamed("quality", "label")
    model = quality_model.train(d, labels)
    scored = docs.withColumn("score", quality_model.score_column(spark, model, F.col("text")))
    assert scored.count() == len(EDGE) and scored.where("score is null").count() == 0
    assert quality_model.train(empty, labels.limit(0)).score(np.zeros(0, np.int32)) == pytest.approx(0.5)
    assert quality_model.train(d, labels.where("label = 1")).score(np.zeros(0, np.int32)) > 0.99


def test_classifier_fits_on_12000_rows(spark, monkeypatch):
    def counting(bits):
        def run(batches):
            n = sum(b.num_rows for b in batches)
            yield pa.RecordBatch.from_arrays([pa.array([b""]), pa.array([b""]), *(pa.array([float(n)]) for _ in range(3))],
                                             ["weight", "square", "intercept", "slope", "shift"])
        return run

    monkeypatch.setattr(quality_model, "_fit_task", counting)
    d = spark.range(12500).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), (F.col("id") % 2).alias("label"))
    assert quality_model.train(d.select("doc_id", "text"), d.select("doc_id", "label")).intercept == 12000


def test_classifier_sends_only_what_weighs(spark):
    """What travels by the driver follows the features in use, not the room for their numbers."""
    import pickle
    d, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet").withColumnRenamed("quality", "label")
    model = quality_model.train(d, labels)
    at = np.arange(1 << model.bits)
    weight, square = model.spread
    used = np.flatnonzero(square)
    assert 0 < len(used) < len(at) // 8 and set(used) <= set(model.features.tolist())
    sent = pickle.dumps(model)
    assert len(sent) < 12 * len(model.features) + 2000  # 8 MB before
    again, row = pickle.loads(sent), np.array(sorted(random.Random(3).sample(used.tolist(), 50)))
    assert again.score(row) == model.score(row)
    assert again.margin(row) == pytest.approx(again.intercept + weight[row].sum() / square[row].sum() ** 0.5, rel=1e-5)


# pipeline

def test_pipeline_stage_by_stage(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    cols, cur = d.columns, d
    for name, stage in corpus_pipeline.STAGES:
        before = cur.toPandas()
        cur = corpus_pipeline.stored(stage(spark, cur, SF), "test-stage")
        after = cur.toPandas()
        if name != "packing":
            assert cur.columns == cols
        if name == "quality_classifier":
            good = queries.op10_quality_classifier(spark, SF).where("predicted = 1").toPandas()
            assert set(after.doc_id) == set(good.doc_id)
            assert after.merge(before, on=cols).shape == after.shape
        elif name == "ngram_jaccard_join":
            sets = {i: shingles(t) for i, t in zip(before.doc_id, before.text)}
            links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
            assert set(after.doc_id) == set(components(sets, links).values())
        elif name == "pii":
            assert set(after.doc_id) == set(before.doc_id) and not any(map(plain_spans, after.text.fillna("")))
            same = before.merge(after, on="doc_id")
            clean = [not plain_spans(t or "") for t in same.text_x]
            assert (same.text_x == same.text_y)[clean].all() and (after.n_chars == after.text.str.len()).all()
        elif name == "mixing":
            plan = mixing.mix(spark.createDataFrame(before, d.schema)).toPandas().set_index("doc_id").copies
            assert after.doc_id.value_counts().to_dict() == plan[plan > 0].to_dict()
        else:
            check_packing(after, after.length.sum())
            assert pd.Series(after.doc_id.unique()).isin(before.doc_id).all()


CLASHES = ("_pii_spans", "_row", "_score", "_more", "id", "n", "key", "size", "taken", "block", "ids", "component_id")


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_edge_rows_and_clashing_columns(spark, stage):
    """Null and empty texts, null and repeated ids, a long text, no rows at all, and columns of any name."""
    run = dict(corpus_pipeline.STAGES)[stage]
    plain = spark.createDataFrame(EDGE, DOCS)
    more = plain.withColumns({c: F.lit(7) for c in CLASHES})
    found, wide = run(spark, plain, SF), run(spark, more, SF)
    columns = [c for c in found.columns if c not in ("sequence_id", "offset")]
    if stage != "packing":
        assert found.columns == plain.columns and wide.columns == more.columns
        assert wide.where(" or ".join(f"{c} <> 7" for c in CLASHES)).isEmpty()
    rows, wide_rows = (sorted(map(str, d.select(*columns).collect())) for d in (found, wide))
    assert rows == wide_rows
    if stage == "ngram_jaccard_join":
        ids = [r.doc_id for r in found.collect()]
        assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 7, 9] and ids.count(None) == 1
    if stage == "pii":
        assert sorted(str(r.text) for r in found.collect()) == sorted(str(r[1]) for r in EDGE)
    if stage == "packing":
        assert found.where("start = 0").count() == len(EDGE)
    assert run(spark, plain.limit(0), SF).count() == 0 and run(spark, more.limit(0), SF).count() == 0
