"""Registered queries of this subpackage, each next to its SQL where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantpulse.llm.exact import exact_groups
from plantpulse.llm.lines import drop_repeated_lines
from plantpulse.llm.negatives import hard_negatives
from plantpulse.llm.packing import pack
from plantpulse.llm.passages import drop_passages
from plantpulse.llm.pieces import digest_documents
from plantpulse.llm.ranking import search
from plantpulse.llm.simhash import hex_fingerprint, near_groups
from plantpulse.llm.suffixes import drop_repeats
from plantpulse.llm.tables import load
from plantpulse.llm.token_counts import count_tokens, rank_scores
from plantpulse.llm.toxicity import judge
from plantpulse.llm.urls import LOWER, UPPER, judge_urls
from plantpulse.llm.vectors import near_vectors

#: Fixed values of the query: host, path, verdict.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: Where vocabulary files lie, if not where the package says.
TOKENIZERS = "PLANTPULSE_TOKENIZERS"
SPACE_SQL = r"[\x20\x09-\x0D]"


def vocabulary(name: str) -> bytes:
    """A public vocabulary file, read on the driver and sent to the tasks."""
    folder = os.environ.get(TOKENIZERS)
    if folder:
        return Path(folder, name).read_bytes()
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_bytes()


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(load(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeated_lines(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP2_SQL = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
x AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^{SPACE_SQL}+|{SPACE_SQL}+$', '', 'g'),
                          '{UPPER}', '{LOWER}') AS key FROM x),
f AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key),
j AS (SELECT k.doc_id, k.pos, k.line, f.first_doc IS NULL OR k.doc_id <= f.first_doc AS stays
      FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE stays), '')) AS kept_sha256
FROM j GROUP BY doc_id"""


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")).drop("row_key")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = rank_scores(vocabulary("piece_bpe_32k.model"))
    return count_tokens(load(spark, sf_dir, "documents"), scores).drop("row_key")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeats(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


OP5_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, pos, substr(h, 2 * pos + 1, 200) AS s
      FROM (SELECT doc_id, h, unnest(range(CAST(length(h) // 2 - 99 AS BIGINT))) AS pos FROM d WHERE length(h) >= 200)),
r AS (SELECT doc_id, pos FROM w
      QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, pos) > 1),
g AS (SELECT doc_id, pos, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS run
      FROM (SELECT *, CASE WHEN pos <= lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 100 THEN 0 ELSE 1 END AS fresh FROM r)),
s AS (SELECT doc_id, min(pos) AS lo, max(pos) + 100 AS hi, lag(max(pos) + 100, 1, 0) OVER (PARTITION BY doc_id ORDER BY min(pos)) AS before
      FROM g GROUP BY doc_id, run),
k AS (SELECT s.doc_id, string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) AS heads,
             max(hi) AS last, sum(hi - lo) AS removed, count(*) AS n FROM s JOIN d ON s.doc_id = d.doc_id GROUP BY s.doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans,
       sha256(unhex(coalesce(heads, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id"""


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_groups(load(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_fingerprint("fingerprint").alias("fingerprint"), "component_id")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(load(spark, sf_dir, "documents")).drop("row_key")


OP7_SQL = rf"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  regexp_replace(coalesce(text, ''), '{SPACE_SQL}', '', 'g') AS key FROM documents),
w AS (SELECT doc_id, key, first_value(doc_id) OVER (PARTITION BY key ORDER BY points DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY key) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(key) AS text_sha256 FROM w"""


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")).drop("row_key")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(load(spark, sf_dir, "embeddings"))


OP9_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
r(node, seen) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.node, l.b FROM r JOIN l ON r.seen = l.a),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT c.node AS vec_id, coalesce(n.n, 0) AS n_links, c.component_id, c.node = c.component_id AS kept
FROM c LEFT JOIN n ON n.a = c.node"""


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return judge_urls(load(spark, sf_dir, "pages"), rules)


OP10_SQL = f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
r AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r)
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(rule_verdict, 'allow') AS verdict
FROM p LEFT JOIN rules ON (host = rule_host OR suffix(host, '.' || rule_host)) AND prefix(path, rule_path)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) = 1"""


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_passages(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP11_SQL = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
w AS (SELECT doc_id, pos, array_to_string(words[pos + 1 : pos + 13], ' ') AS s
      FROM (SELECT doc_id, words, unnest(range(len(words) - 12)) AS pos FROM d WHERE len(words) >= 13)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
g AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS spot FROM w JOIN f ON w.s = f.s AND w.doc_id > f.first),
k AS (SELECT doc_id, list(spot) AS gone FROM g GROUP BY doc_id),
x AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS spot FROM d),
t AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.spot) AS kept FROM x LEFT JOIN g ON g.doc_id = x.doc_id AND g.spot = x.spot
      WHERE g.spot IS NULL GROUP BY x.doc_id)
SELECT d.doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    picked = rows.filter(finite).select("vec_id", label.alias("label"), whole.alias("vector"), (F.col("vec_id") % 50 == 0).alias("anchor"))
    return hard_negatives(picked)


OP12_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
             CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
       AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score),
r AS (SELECT *, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS rank FROM n)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 3"""


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


OP13_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
OP13_SQL = rf"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{OP13_TERM}')) AS term FROM documents),
f AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM f GROUP BY doc_id),
t AS (SELECT count(*) AS N, CAST(sum(n) AS BIGINT) AS L FROM n),
w AS (SELECT term, CAST(floor(1000 * ln((2 * t.N + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, t GROUP BY term, t.N),
m AS (SELECT doc_id, 100 - 75 + (75 * n.n * t.N) // t.L AS m FROM n, t),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{OP13_TERM}')) AS term FROM benchmark),
s AS (SELECT item_id, f.doc_id, CAST(sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 8 * m.m))) AS BIGINT) AS score
      FROM q JOIN f ON q.term = f.term JOIN w ON w.term = f.term JOIN m ON m.doc_id = f.doc_id GROUP BY item_id, f.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_line_dedup": op2_line_dedup,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_token_counts": op4_token_counts,
        "op5_suffix_dedup": op5_suffix_dedup,
        "op6_simhash_dedup": op6_simhash_dedup,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_toxicity": op8_toxicity,
        "op9_embedding_dedup": op9_embedding_dedup,
        "op10_url_filters": op10_url_filters,
        "op11_substring_dedup": op11_substring_dedup,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_ranked_search": op13_ranked_search,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": OP2_SQL,
        "op5_suffix_dedup": OP5_SQL,
        "op7_exact_dedup": OP7_SQL,
        "op9_embedding_dedup": OP9_SQL,
        "op10_url_filters": OP10_SQL,
        "op11_substring_dedup": OP11_SQL,
        "op12_hard_negatives": OP12_SQL,
        "op13_ranked_search": OP13_SQL,
    }
