"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinloom.llm import classifier, codes, divergence, exact, lexical, mixing, near, packing, pii, pitman_yor, repeats, token_files, warc


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archived(_read(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
WITH captured AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
     hashed AS (SELECT page_id, body, sha1(body) AS digits, max(page_id) OVER (PARTITION BY body) AS first FROM captured)
SELECT page_id, octet_length(encode(body)) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(digits, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31)::BIGINT + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM hashed
"""


def op2_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return pitman_yor.score(_read(spark, sf_dir, "documents"), held_out)


def op3_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_read(spark, sf_dir, "documents")).drop("row")


def op4_exact_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.decisions(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP4_SQL = r"""
WITH plain AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM plain WINDOW same AS (PARTITION BY body)
"""


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near.near_duplicates(_read(spark, sf_dir, "documents"), size=3, similar=(85, 100))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))  # by number, where the operator keeps one row
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def op6_nearest_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.nearest(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=10)


OP6_SQL = """
WITH codes AS (SELECT vec_id, list_transform(embedding, lambda x: (x > 0)::INT) AS bits FROM embeddings),
     pairs AS (
         SELECT q.vec_id AS query_id, c.vec_id,
                list_sum(list_transform(list_zip(q.bits, c.bits), lambda z: (z[1] <> z[2])::INT))::INT AS distance
         FROM codes q JOIN codes c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INT AS rank FROM pairs)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= 10
"""


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    weights = classifier.learned(docs, _read(spark, sf_dir, "labels"), ~held_out)
    return classifier.score(docs.select("doc_id", "text"), weights).select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def op8_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(_read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents")).select(
        "doc.doc_id", "source", "pass", "block", "place", "n_words", F.round("weight", 9).alias("weight")
    )


def op11_ranked_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build(_read(spark, sf_dir, "documents"))
    return lexical.search(index, _read(spark, sf_dir, "benchmark"), k=10)


OP11_SQL = r"""
WITH doc_terms AS (
         SELECT d, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
         FROM (SELECT row_number() OVER () AS d, * FROM documents)),
     postings AS (SELECT d, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM doc_terms GROUP BY d, term),
     lengths AS (SELECT d, sum(tf)::BIGINT AS n FROM postings GROUP BY d),
     totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
     norms AS (SELECT d, 25 + (75 * n * docs) // terms AS m FROM lengths, totals),
     weights AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM postings, totals GROUP BY term, docs),
     item_terms AS (
         SELECT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
         FROM (SELECT row_number() OVER () AS i, * FROM benchmark)),
     asked AS (SELECT i, any_value(item_id) AS item_id, term, count(*) AS times FROM item_terms GROUP BY i, term),
     scored AS (
         SELECT i, any_value(item_id) AS item_id, d, any_value(doc_id) AS doc_id,
                sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
         FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN norms USING (d) GROUP BY i, d),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INT AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_read(spark, sf_dir, "documents"), min_docs=30, shown=50)


OP12_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
     terms AS (SELECT d, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
     kept AS (SELECT lang, term, count(*) AS lang_n FROM terms GROUP BY ALL HAVING count(DISTINCT d) >= 30),
     langs AS (SELECT lang, count(*) AS v, sum(lang_n)::BIGINT AS lang_total FROM kept GROUP BY lang),
     occurring AS (SELECT DISTINCT lang, source FROM docs),
     counted AS (SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY ALL),
     totals AS (SELECT lang, source, sum(n)::BIGINT AS total FROM counted GROUP BY ALL),
     dense AS (
         SELECT o.lang, o.source, k.term, coalesce(c.n, 0) AS n,
                1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(t.total, 0) + 5 * l.v) AS p,
                1 + (1000000000::HUGEINT * (k.lang_n + 5)) // (l.lang_total + 5 * l.v) AS q
         FROM occurring o JOIN langs l USING (lang) JOIN kept k USING (lang)
         LEFT JOIN counted c USING (lang, source, term) LEFT JOIN totals t USING (lang, source)),
     term_part AS (
         SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value,
                row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term)::INT AS rank
         FROM dense WHERE n > 0 AND p > q),
     apart AS (
         SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
         FROM dense a JOIN dense b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
     pair_part AS (
         SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value,
                row_number() OVER (PARTITION BY a.lang, a.source ORDER BY coalesce(x.value, 0) DESC, b.source)::INT AS rank
         FROM occurring a JOIN occurring b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source)
SELECT * FROM pair_part UNION ALL SELECT * FROM term_part WHERE rank <= 50
"""


def op13_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write(_read(spark, sf_dir, "documents"))
    n_tokens = (F.octet_length("ids") / 4).cast("bigint")
    return token_files.read(spark, files).select("doc_id", "start", n_tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


QUERIES = {
    "op9_repeated_passages": op9_repeated_passages,
    "op1_capture_index": op1_capture_index,
    "op11_ranked_lexical": op11_ranked_lexical,
    "op10_temperature_mixing": op10_temperature_mixing,
    "op12_source_divergence": op12_source_divergence,
    "op13_token_ids": op13_token_ids,
    "op2_pitman_yor": op2_pitman_yor,
    "op3_contextual_pii": op3_contextual_pii,
    "op4_exact_groups": op4_exact_groups,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_nearest_codes": op6_nearest_codes,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_harmonic_packing": op8_harmonic_packing,
}
ORACLES = {
    "op1_capture_index": OP1_SQL,
    "op11_ranked_lexical": OP11_SQL,
    "op12_source_divergence": OP12_SQL,
    "op4_exact_groups": OP4_SQL,
    "op6_nearest_codes": OP6_SQL,
}
