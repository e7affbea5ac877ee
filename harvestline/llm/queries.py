"""The corpus queries, opN_<name>, over whole tables with production parameters."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import (
    bitpack,
    clustering,
    embed_dedup,
    html_extract,
    merkle,
    mixing,
    ngram_join,
    packing,
    pieces,
    pii,
    quality_model,
    quality_rules,
    token_counts,
)
from .common import prepare


def word_vocabulary() -> str:
    """Where the installed word-level vocabulary lies."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def piece_vocabulary() -> str:
    """Where the installed sentencepiece vocabulary lies."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    return mixing.mix(docs)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return token_counts.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), word_vocabulary())


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    return html_extract.extract(pages).withColumn("n_chars", F.length("text").cast("long"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op6_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitpack.round_trip(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), word_vocabulary())


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    spans = pii.with_spans(docs).select("doc_id", "pii_spans")

    def of(kind):
        return F.size(F.filter("pii_spans", lambda p: p["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("pii_spans", lambda p: p["kind"].isin(*pii.BASE))
    return spans.select("doc_id", *[of(k) for k in pii.BASE], F.sha2(pii.joined(base), 256).alias("base_sha256"),
                        pii.joined(F.col("pii_spans")).alias("spans"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_rules.ledger(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~quality_rules.passes("base")).alias("base_failed"),
                       quality_rules.passes("v1").alias("kept"), F.col("failed").alias("failed_bits"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"]))


def held_out(doc_id="doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2


def fitted_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality_model.Model:
    """The quality model from labelled rows that are not held out."""
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    return quality_model.train(docs, labels.where(~held_out()).select("doc_id", F.col("quality").alias("label")))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(prepare(spark), sf_dir, "documents", ["doc_id", "text"])
    score = quality_model.score_column(spark, fitted_model(spark, sf_dir, docs), F.col("text"))
    return (docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), score.alias("score"))
                .withColumn("predicted", (F.col("score") >= quality_model.THRESHOLD).cast("int")))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", list(merkle.FIELDS))
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    return merkle.proofs(merkle.build(docs, altered=F.when(tampered, merkle.row_digest(text=lowered))))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.report(*clustering.cluster(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return pieces.round_trip(docs, piece_vocabulary()).select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("decoded_sha256"), "agrees")


QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_token_counts, op3_packing, op4_html_extraction, op5_ngram_join, op6_bit_packing, op7_pii,
    op8_quality_rules, op9_embedding_dedup, op10_quality_classifier, op11_merkle_manifest, op12_centroid_clustering, op13_sentencepiece)}

# the six ASCII white-space characters, for DuckDB's regular expressions
_W = r"[^\x20\x09-\x0D]+"

_MATCHES = """list_transform(range(1, len(m) + 1), lambda i: {{
        's': list_sum(list_transform(s[1:i], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)::BIGINT,
        'v': m[i]}}) FROM (SELECT regexp_extract_all(t, '{p}') AS m, regexp_split_to_array(t, '{p}') AS s)"""

_PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
           "len(list_filter(string_split(x.v, '.'), lambda o: length(ltrim(o, '0')) > 3 OR right('000' || o, 3)::INT > 255)) = 0"),
    "card": (r"[0-9]([\x20-]?[0-9])+",
             "length(regexp_replace(x.v, '[^0-9]', '', 'g')) BETWEEN 16 AND 19 AND "
             "list_sum(list_transform(string_split(reverse(regexp_replace(x.v, '[^0-9]', '', 'g')), ''), "
             "lambda c, i: CASE WHEN i % 2 = 1 THEN c::INT WHEN c::INT > 4 THEN c::INT * 2 - 9 ELSE c::INT * 2 END)) % 10 = 0"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "length(regexp_replace(x.v, '[^0-9]', '', 'g')) BETWEEN 8 AND 15"),
}


def _pii_sql() -> str:
    lists = ",\n".join(
        f"(SELECT list_filter(f, lambda x: {ok}) FROM (SELECT {_MATCHES.format(p=p)} q(m, s)) r(f)) AS {k}"
        for k, (p, ok) in _PII.items())
    text = " || ".join(f"coalesce(list_aggregate(list_transform({k}, lambda x: '{k}:' || x.s || ':' || (x.s + length(x.v)) || ','), "
                       "'string_agg', ''), '')" for k in _PII)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS (SELECT doc_id, {lists} FROM d),
j AS (SELECT *, rtrim({text}, ',') AS spans FROM f)
SELECT doc_id, {', '.join(f'len({k})::BIGINT AS n_{k}' for k in _PII)}, sha256(spans) AS base_sha256, spans FROM j
"""


def _tree_sql(name: str, start: str, levels: int) -> str:
    """CTEs name0, name1, ... (tree, i, h, n): the levels of 16-ary trees over ``start``; a lone node stays."""
    ctes = [f"{name}0 AS (SELECT tree, i, h, count(*) OVER (PARTITION BY tree) AS n FROM ({start}))"]
    for k in range(levels):
        up = f"(SELECT tree, i // 16 AS i, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{k} GROUP BY tree, i // 16)"
        ctes.append(f"{name}{k + 1} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {up})")
    return ",\n".join(ctes)


def _siblings_sql(name: str, levels: int) -> str:
    """CTE name_s (tree, k, i, l, r): what stands left and right of a node in its run, by level."""
    return f"{name}_s AS (" + " UNION ALL ".join(
        f"""SELECT tree, {k} AS k, i, n > 1 AS up,
        coalesce(string_agg(h, '') OVER (PARTITION BY tree, i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(h, '') OVER (PARTITION BY tree, i // 16 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
        FROM {name}{k}""" for k in range(levels)) + ")"


def _merkle_sql(levels: int = 6) -> str:
    """Enough levels for 16 ** levels rows a source and sources."""
    def leaf(text):
        parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(parts)})"

    crc = """list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda a, b:
        list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384)))"""
    steps, last = [], "f0"
    for k in range(2 * levels):
        tree, at, place = ("f.tree", f"f.i // (16 ** {k})::BIGINT", k) if k < levels else ("0", f"f.place // (16 ** {k - levels})::BIGINT", k - levels)
        steps.append(f"""f{k + 1} AS (SELECT f.* REPLACE (CASE WHEN s.up THEN sha256(s.l || f.folded || s.r) ELSE f.folded END AS folded,
        CASE WHEN s.up THEN f.proof || s.l || s.r ELSE f.proof END AS proof)
        FROM f{k} f JOIN {'t' if k < levels else 'u'}_s s ON s.tree = {tree} AND s.k = {place} AND s.i = {at})""")
        last = f"f{k + 1}"
    return f"""
WITH d AS (SELECT doc_id, source, {leaf('text')} AS leaf,
  CASE WHEN xor({crc}, 4294967295) % 5 = 0 THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other
  FROM documents),
p AS (SELECT *, dense_rank() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS tree,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
{_tree_sql('t', 'SELECT tree, i, leaf AS h FROM p', levels)},
{_siblings_sql('t', levels)},
{_tree_sql('u', f'SELECT 0 AS tree, tree AS i, h FROM t{levels}', levels)},
{_siblings_sql('u', levels)},
f0 AS (SELECT doc_id, leaf, tree, i, tree AS place, coalesce(other, leaf) AS folded, '' AS proof FROM p),
{', '.join(steps)}
SELECT f.doc_id, f.leaf, t.h AS subroot, u.h AS root, sha256(f.proof) AS proof_sha256, f.folded AS folded_root, f.folded = u.h AS verified
FROM {last} f JOIN t{levels} t ON t.tree = f.tree CROSS JOIN u{levels} u
"""


def _clustering_sql(k: int = 8, rounds: int = 10) -> str:
    ctes = []
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (SELECT row, vec_id, x, min_by(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
          SELECT v.row, v.vec_id, v.x, c.cluster, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
          FROM v CROSS JOIN c{r} c) GROUP BY row, vec_id, x)""")
        if r < rounds:
            ctes.append(f"""m{r} AS (SELECT cluster, list(((s - ((s % n) + n) % n) / n)::BIGINT ORDER BY j) AS x FROM (
              SELECT cluster, j, sum(e)::BIGINT AS s, count(*) AS n FROM (SELECT cluster, unnest(x) AS e, generate_subscripts(x, 1) AS j FROM a{r})
              GROUP BY cluster, j) GROUP BY cluster),
            c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m ON m.cluster = c.cluster)""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, x FROM (SELECT sha256('3:' || vec_id) AS h, x FROM v ORDER BY h LIMIT {k})),
{', '.join(ctes)}
SELECT vec_id, a.cluster::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.cluster = a.cluster
"""


ORACLE = {
    "op11_merkle_manifest": _merkle_sql(),
    "op12_centroid_clustering": _clustering_sql(),
    "op5_ngram_join": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_W}') AS w
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' '))) AS g
  FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
r AS (SELECT DISTINCT x AS doc_id, x AS y FROM l UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT doc_id, min(y) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id
""",
    # sf0.01 holds no IBAN and no account number named as such, the kinds beyond the base that the operator reports
    "op7_pii": _pii_sql(),
    "op9_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
n AS (SELECT x AS vec_id, count(*) AS n FROM l GROUP BY x),
r AS (SELECT DISTINCT x AS vec_id, x AS y FROM l UNION SELECT r.vec_id, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT vec_id, min(y) AS component_id FROM r GROUP BY vec_id)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c.component_id, e.vec_id) AS component_id,
       coalesce(c.component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.vec_id = e.vec_id LEFT JOIN c ON c.vec_id = e.vec_id
""",
    "op8_quality_rules": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{_W}') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_W}')) AS l FROM d),
p AS (SELECT doc_id, i, list_aggregate(w[i:i + 2], 'string_agg', ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
q AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM p) WHERE c > 1),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM q) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN r ON r.doc_id = w.doc_id),
b AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
                 + CASE WHEN 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END + CASE WHEN n_words > 0 AND word_chars < 2 * n_words THEN 8 ELSE 0 END
                 + CASE WHEN word_chars > 15 * n_words THEN 16 ELSE 0 END
                 + CASE WHEN n_lines > 0 AND 100 * n_dup_lines > 30 * n_lines THEN 32 ELSE 0 END)::BIGINT AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits & 3 <> 0 AS base_failed,
       failed_bits = 0 AS kept, failed_bits
FROM b
""",
}
