"""Registered queries of the training-data operators, and SQL for those that SQL expresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontamination, divergence, lattice_dedup, license_scan, near_dedup, packing, pii, quality, sharding, suffix_dedup, token_rollup, warc
from .common import scratch_path, table

SHARDS = 40


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    n = lambda kind: F.size(F.filter("base", lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[n(kind) for kind in pii.BASE],
        F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"),
        pii.spans_text(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.quality(docs, lang="lang").select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(table(spark, sf_dir, "documents"), SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = token_rollup.Store(spark, scratch_path(spark, "token-store"))
    return token_rollup.maintained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), tokenizer_path(), store)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))
    text = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x.s, x.e)), ",")
    return found.select("doc_id", F.size("spans").cast("long").alias("n_spans"), "repeated_words", text.alias("spans"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("spans")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def queries() -> dict:
    own = (op1_pii, op2_quality, op3_warc, op4_near_dedup, op5_sharding, op6_token_counts, op7_suffix_dedup, op8_decontamination, op9_licenses, op10_packing, op11_collocations, op12_divergence, op13_embedding_dedup)
    return {f.__name__: f for f in own}


OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), one AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w
), g AS (
  SELECT doc_id, i, word || ' ' || lead(word, 1) OVER a || ' ' || lead(word, 2) OVER a AS g
  FROM one WINDOW a AS (PARTITION BY doc_id ORDER BY i)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g WHERE g IS NOT NULL) WHERE n > 1
), r AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id
), l AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM w
), s AS (
  SELECT doc_id, count(*) AS n FROM one WHERE lower(word) IN ({stops}) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, w.lang, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, coalesce(s.n, 0) AS n_stop_words
  FROM w JOIN l USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN s USING (doc_id)
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {rules} AS kept
FROM f
"""

OP3_SQL = """
SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, {base32} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM (SELECT *, sha1(coalesce(html, '')) AS d, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
"""

ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11_SQL = r"""
WITH w AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({lower}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents)
), total AS (
  SELECT lang, sum(len(ws))::HUGEINT AS n FROM w GROUP BY lang
), g AS (
  SELECT lang, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM w, range(1, 6) t(k)
), f AS (
  SELECT lang, k, phrase, count(*)::HUGEINT AS a FROM (SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase FROM g)
  GROUP BY ALL HAVING count(*) >= 100
), c AS (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1
), cut AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, n, j, 1000 * c.a * n // (x.a * y.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c JOIN total USING (lang)
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1 : j], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[j + 1 :], ' ')
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inside AS (
  SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY ALL
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM best LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a
) WHERE rank <= 2000
"""

OP12_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row, {lower} AS t FROM documents
), w AS (
  SELECT lang, source, row, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS c FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 30
), grp AS (
  SELECT DISTINCT lang, source FROM d
), n AS (
  SELECT lang, source, term, count(*)::HUGEINT AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL
), sizes AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS lang_n FROM kept GROUP BY lang
), full_ AS (
  SELECT g.lang, g.source, k.term, coalesce(n.c, 0) AS c, k.c AS all_c, v, lang_n, coalesce(m.group_n, 0) AS group_n
  FROM grp g JOIN kept k USING (lang) JOIN sizes USING (lang) LEFT JOIN n USING (lang, source, term)
  LEFT JOIN (SELECT lang, source, sum(c)::HUGEINT AS group_n FROM n GROUP BY ALL) m USING (lang, source)
), p AS (
  SELECT lang, source, term, c, 1 + 1000000000 * (c + 5) // (group_n + 5 * v) AS p, 1 + 1000000000 * (all_c + 5) // (lang_n + 5 * v) AS q FROM full_
), pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND x.term = y.term
  WHERE x.term IS NULL OR y.term IS NOT NULL GROUP BY ALL
), term AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, value, rank::INT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
) WHERE part = 'pair' OR rank <= 50
"""

OP13_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), ok AS (
  SELECT vec_id, e, len(e) AS d FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.d = b.d AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS v, vec_id AS r FROM v UNION SELECT v, b FROM reach JOIN link ON a = r
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN (SELECT v AS vec_id, min(r) AS component_id FROM reach GROUP BY v) USING (vec_id) LEFT JOIN (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a) USING (vec_id)
"""


def oracle_sql() -> dict[str, str]:
    stops = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
    other = lambda r: f"coalesce(nullif(lower(regexp_extract(lang, '^[^-_]*')), '') NOT IN {r.languages}, false) OR " if r.languages else ""
    rules = " AND ".join(f"({other(r)}{r.times} * {r.metric} <= {r.bound} * {r.per})" for r in quality.RULES)
    # Five hexadecimal digits are four of base 32.
    hexes = [f"(('0x' || substr(d, {1 + 5 * g}, 5))::BIGINT)" for g in range(8)]
    base32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (({h} >> {s}) & 31)::INT, 1)" for h in hexes for s in (15, 10, 5, 0))
    return {
        "op2_quality": OP2_SQL.format(stops=stops, rules=rules),
        "op3_warc": OP3_SQL.format(base32=base32),
        "op11_collocations": OP11_SQL.format(lower=ASCII_LOWER),
        "op12_divergence": OP12_SQL.format(lower=ASCII_LOWER),
        "op13_embedding_dedup": OP13_SQL,
    }
