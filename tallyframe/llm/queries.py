"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import (
    byte_bpe, host_rules, jaccard_join, lexical, licenses, neighbours, packing, periodic, quality, secrets, sign_dedup,
    substring_dedup, toxicity,
)
from tallyframe.llm.common import read_table
from tallyframe.llm.vocabulary import Vocabulary


def vocabulary(name: str) -> Vocabulary:
    """A public rank file with the pattern and, if it is there as JSON too, the added tokens that belong to it."""
    import public_tokenizers

    full = public_tokenizers.path(name.replace(".tiktoken", ".json"))
    return Vocabulary.read(public_tokenizers.path(name), public_tokenizers.PATTERN, full if os.path.exists(full) else None)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.apply_host_rules(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "host", "host_docs", "host_failed", "host_rate",
    )


#: Patterns are given with explicit characters, as both engines read them alike.
OP2_SQL = r"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d
),
grams AS (
  SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)
),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM grams),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice WHERE n > 1) GROUP BY doc_id
),
f AS (
  SELECT d.doc_id, d.host, len(w.words) AS n_words,
    len(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
      - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d JOIN w USING (doc_id) LEFT JOIN covered USING (doc_id)
),
g AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
h AS (SELECT host, count(*) AS host_docs, sum(base_failed::INT)::BIGINT AS host_failed FROM g GROUP BY host),
p AS (SELECT avg(host_failed / host_docs) AS m, var_pop(host_failed / host_docs) AS v FROM h),
k AS (SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1.0), 1000.0) ELSE 1000.0 END AS k FROM p),
r AS (SELECT h.*, round((host_failed + m * k) / (host_docs + k), 6) AS host_rate FROM h, k)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND host_rate <= 0.5 AS kept, g.host, host_docs, host_failed, host_rate
FROM g JOIN r ON g.host IS NOT DISTINCT FROM r.host
"""


def op3_line_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = vocabulary("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode(read_table(spark, sf_dir, "documents"), ranks, decoded=True).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("body", 256).alias("decoded_sha256"),
    )


def op5_license_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def license_sql() -> str:
    """Every run of every text against every template, by their shingles."""
    templates = licenses.templates_of(licenses.TEMPLATES)
    shingles = ", ".join(f"('{t.name}', {len(t.words)}, {len(t.shingles)}, {t.needed}, '{s}')" for t in templates for s in t.shingles)
    return f"""
WITH t(license, size, total, needed, shingle) AS (VALUES {shingles}),
w AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{licenses.UPPER}', '{licenses.LOWER}'), '[a-z0-9]+') AS words
  FROM documents WHERE text IS NOT NULL
),
p AS (SELECT doc_id, words, len(words) AS n, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS pos FROM w WHERE len(words) > 0),
s AS (SELECT doc_id, n, pos, array_to_string(words[pos : pos + 4], ' ') AS shingle FROM p),
h AS (
  SELECT s.doc_id, t.license, t.total, t.needed, shingle,
    unnest(range(greatest(1, pos - greatest(size - 5, 0)), least(pos, greatest(1, n - size + 1)) + 1)) AS start
  FROM s JOIN t USING (shingle)
),
r AS (
  SELECT doc_id, license, start, count(DISTINCT shingle) AS shared, max(total) AS total, max(needed) AS needed
  FROM h GROUP BY doc_id, license, start
)
SELECT doc_id, license, count(*) AS windows, (min(start) - 1)::BIGINT AS first_word, round(max(shared / total), 6) AS containment
FROM r WHERE shared >= needed GROUP BY doc_id, license
"""


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_versions(read_table(spark, sf_dir, "documents"), secrets.shared_ledger(spark))
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")
    text = F.array_join(F.transform("findings", lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
    return found.select(
        F.col("path").alias("doc_id"), count("assign"), count("access"), count("hex"),
        F.sha2(text.cast("binary"), 256).alias("base_sha256"), text.alias("spans"),
    )


def op7_toxic_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_block_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


def op11_sign_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sign_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


#: Every pair of one label; a component is walked from its ids on.
OP11_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
p AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM p GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""


def repeat_tails(documents: DataFrame) -> DataFrame:
    """``documents`` whose texts end in repetitions, as the query's contract asks for a tenth of the ids.

    With h the CRC-32 of the id and g = h div 10: where h leaves 0 when divided by 10, each of
    the n words from place a = g mod n on is replaced by the one that stands where a stretch
    of 1 + (n - a) div (3 + g mod 8) words from a on, repeated, would have it.
    """
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    # Words are made only where they are needed.
    chosen = documents.withColumn("__h", h).withColumn("__words", F.when(F.col("__h") % 10 == 0, words))
    tail = """
        transform(__words, (word, i) -> if(
            i < __a, word, element_at(__words, cast(__a + (i - __a) % (1 + (size(__words) - __a) div (3 + __h div 10 % 8)) + 1 as int))
        ))
    """
    placed = chosen.withColumn("__a", F.when(F.size("__words") > 0, F.expr("__h div 10 % size(__words)")))
    repeated = F.when(F.col("__a").isNotNull(), F.array_join(F.expr(tail), " ")).otherwise(F.col("text"))
    return placed.withColumn("text", repeated).drop("__h", "__words", "__a")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = repeat_tails(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.find_runs(texts).withColumn("longest", periodic.longest_run(F.col("runs")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start", "longest.length", "longest.period",
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(periodic.runs_text(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def _terms_sql(table: str, key: str) -> str:
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    return f"SELECT {key}, regexp_extract_all(translate(text, '{licenses.UPPER}', '{licenses.LOWER}'), '{pattern}') AS terms FROM {table}"


OP13_SQL = f"""
WITH d AS (SELECT doc_id, terms, len(terms) AS n FROM ({_terms_sql("documents", "doc_id")}) WHERE len(terms) > 0),
c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM d),
f AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM d) GROUP BY ALL),
h AS (SELECT term, count(*) AS df FROM f GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w FROM h, c),
q AS (SELECT DISTINCT item_id, unnest(terms) AS term FROM ({_terms_sql("benchmark", "item_id")})),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN w USING (term), c GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50
"""


QUERIES = {
    "op1_substring_dedup": (op1_substring_dedup, None),
    "op2_host_rules": (op2_host_rules, OP2_SQL),
    "op3_line_field": (op3_line_field, None),
    "op4_byte_bpe": (op4_byte_bpe, None),
    "op5_license_windows": (op5_license_windows, license_sql()),
    "op6_secret_ledger": (op6_secret_ledger, None),
    "op7_toxic_terms": (op7_toxic_terms, None),
    "op8_block_neighbours": (op8_block_neighbours, None),
    "op9_jaccard_join": (op9_jaccard_join, None),
    "op10_best_fit_packing": (op10_best_fit_packing, None),
    "op11_sign_dedup": (op11_sign_dedup, OP11_SQL),
    "op12_periodic_runs": (op12_periodic_runs, None),
    "op13_lexical_search": (op13_lexical_search, OP13_SQL),
}
