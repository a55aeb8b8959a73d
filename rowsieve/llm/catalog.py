"""Registered queries of this package, and their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsieve.llm import chat, decontaminate, fingerprints, hard_negatives, packing, pii, quality, sharding, toxicity, urls, warc, whitening
from rowsieve.llm.near_dedup import near_duplicates
from rowsieve.llm.tables import read


def op1_minhash_near_dedup(spark, sf_dir):
    """Whole ``documents``: class of near copies of every document."""
    return near_duplicates(read(spark, sf_dir, "documents"))


def tokenizer_path(name="word_bpe_49k.json"):
    """Where a public vocabulary file lies; it is never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_imatch_fingerprints(spark, sf_dir):
    """Fingerprints of every whole text of ``documents`` and its edited text."""
    return fingerprints.compare_neighbours(read(spark, sf_dir, "documents"))


def op3_offset_aligned_chat(spark, sf_dir):
    """All ``conversations`` and conversation -1, whose texts look like another
    template's control strings, formatted and read back."""
    odd = spark.sql(
        "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    return chat.digests(chat.format_chats(rows, tokenizer_path("byte_bpe_50k.json")))


def op4_sum_of_squares_packing(spark, sf_dir):
    """Whole ``documents`` as pieces of packed sequences."""
    return packing.with_digests(packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())).drop("ids")


def op5_weighted_hash_tree_sharding(spark, sf_dir):
    """All ``documents`` in eight shards of equal weight, and in nine."""
    return sharding.assign(read(spark, sf_dir, "documents"), sharding.even_tree(8))


def op6_disclosure_pii(spark, sf_dir):
    """Personal data in every whole text of ``documents``."""
    return pii.find(read(spark, sf_dir, "documents"))


def op7_quality_factorisation_machine(spark, sf_dir):
    """Quality score of every whole text of ``documents``."""
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_seekable_warc(spark, sf_dir):
    """A record per row of ``pages``, written to bundles and read back."""
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op9_template_decontamination(spark, sf_dir):
    """Every document of ``documents``: benchmark passages that it holds."""
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_toxicity_compression_distance(spark, sf_dir):
    """Toxicity score of every whole text of ``documents``."""
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


#: Rules of the URL filter: verdict, host (with its subdomains), path prefix.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Hosts whose names hold one of these words are on the list.
LISTED_HOSTS = ("casino", "pills")


def op11_bloom_cascade_url_filter(spark, sf_dir):
    """Verdict on every url of ``pages``: rules, and the list of addresses on
    hosts with listed words, compiled into one cascade."""
    pages = read(spark, sf_dir, "pages")
    return urls.judge(pages, URL_RULES, urls.addresses_on(pages, LISTED_HOSTS))


def op12_embedding_whitening(spark, sf_dir):
    """Whole ``embeddings`` on the 32 leading components of their covariance."""
    return whitening.whiten(read(spark, sf_dir, "embeddings"), 32)


def op13_rtree_hard_negatives(spark, sf_dir):
    """Hard negatives of every anchor of ``embeddings`` (ids divisible by 50)
    among all rows; ids divisible by 7 take the next label."""
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    label = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label)


QUERIES = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup,
        op2_imatch_fingerprints,
        op3_offset_aligned_chat,
        op4_sum_of_squares_packing,
        op5_weighted_hash_tree_sharding,
        op6_disclosure_pii,
        op7_quality_factorisation_machine,
        op8_seekable_warc,
        op9_template_decontamination,
        op10_toxicity_compression_distance,
        op11_bloom_cascade_url_filter,
        op12_embedding_whitening,
        op13_rtree_hard_negatives,
    )
}

#: Links of shingle sets and their closure, from scratch.
_OP1_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
    ELSE list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
rows AS (SELECT doc_id, len(s) AS n, s FROM sets),
items AS (SELECT doc_id, n, unnest(s) AS x FROM rows),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS id, doc_id AS c FROM rows UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.c = links.a),
least AS (SELECT id, min(c) AS c FROM reach GROUP BY id)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept FROM rows JOIN least ON id = doc_id
"""

#: Hosts, paths and rules written out; membership in the list is the predicate that made it.
_OP11_SQL = """
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id,
    translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM rest),
rules(verdict, h, p) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fitting AS (
  SELECT DISTINCT host, path, arg_max(h || p, length(h || p)) OVER same AS rule, arg_max(verdict, length(h || p)) OVER same AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  WINDOW same AS (PARTITION BY host, path))
SELECT page_id, parts.host, parts.path, rule,
  coalesce(verdict, CASE WHEN contains(parts.host, 'casino') OR contains(parts.host, 'pills') THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fitting ON parts.host = fitting.host AND parts.path = fitting.path
"""

#: Every anchor against all rows.
_OP13_SQL = """
WITH rows AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scores AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS s
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (SELECT a, b, s FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5),
negatives AS (
  SELECT p.a AS anchor_id, p.b AS positive_id, n.b AS negative_id, p.s AS positive_score, n.s AS negative_score
  FROM positives p JOIN scores n ON p.a = n.a AND NOT n.same AND 50 * p.s <= 100 * n.s AND 100 * n.s <= 95 * p.s)
SELECT *, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS INTEGER) AS rank
FROM negatives QUALIFY rank <= 3
"""

ORACLE_SQL = {"op1_minhash_near_dedup": _OP1_SQL, "op11_bloom_cascade_url_filter": _OP11_SQL, "op13_rtree_hard_negatives": _OP13_SQL}
