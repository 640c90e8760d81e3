"""Registered queries of the text operators, and the SQL that some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchloom.llm import bpe, decontam, fixity, html, idfiles, laesa, langid, lm, pqcodes, quality, sharding, simhash, toxicity
from batchloom.llm.common import id_remainder, table
from batchloom.storage import work_path


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.encode_and_decode(docs, path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality.quality(docs).select("doc_id", "quality.*").drop("cleaned")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_labels(docs, table(spark, sf_dir, "labels"))
    return docs.select("doc_id", toxicity.severity(F.col("text"), model).alias("s")).select("doc_id", "s.*")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return sharding.interleaved(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rest = id_remainder(F.col("doc_id"), 3)
    trees = langid.learn(docs.where(rest != 1))
    return docs.select(
        "doc_id",
        F.coalesce(rest == 1, F.lit(False)).alias("held_out"),
        langid.language(F.col("text"), trees).alias("found"),
    ).select("doc_id", "held_out", "found.*")


#: What befalls the second replica of op8: of every DAMAGE pages about one is altered and one is lost.
DAMAGE = 499


def op8_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of two replicas of an archive of ``pages``; in the second, some records are altered or lost."""
    pages = table(spark, sf_dir, "pages").select("page_id", fixity.warc_record(F.col("url"), F.col("html")).alias("record"))
    first = fixity.materialise(fixity.place_records(pages, "page_id"), "archive")
    return fixity.audit(first, fixity.at_index(damaged(pages), "page_id", first)).withColumnRenamed("key", "page_id")


def damaged(records: DataFrame) -> DataFrame:
    """The second replica's records (page_id, was, record): lost ones are absent, the bytes of others overwritten.

    An overwritten record holds the digest of what it was and an exclamation mark, 65 bytes in place of all it had.
    """
    fate = F.coalesce(F.col("page_id") % DAMAGE, F.lit(0))
    was = F.sha2(F.col("record").cast("binary"), 256)
    record = F.when(fate == 3, F.concat(was, F.lit("!"))).otherwise(F.col("record"))
    return records.where(fate != 7).select("page_id", was.alias("was"), record.alias("record"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )




def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = pqcodes.quantise(table(spark, sf_dir, "embeddings"))
    hexed = F.array_join(F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return pqcodes.with_label_error(coded).select(
        "vec_id", hexed.alias("code"), "error", "label_error", F.lit(pqcodes.books_digest(books)).alias("codebooks_sha256")
    )


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "token-files")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    idfiles.write_token_files(docs, folder, public_tokenizers.path("byte_bpe_50k.json"))
    return idfiles.read_token_files(spark, folder, with_ids=False)


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centroids = laesa.cluster_vectors(table(spark, sf_dir, "embeddings"))
    return laesa.with_inertia(assigned, centroids)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bpe,
        op2_quality,
        op3_toxicity,
        op4_decontamination,
        op5_main_text,
        op6_sharding,
        op7_language,
        op8_fixity,
        op9_simhash,
        op10_lm,
        op11_codes,
        op12_token_files,
        op13_clusters,
    )
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Kept vectors as whole doubles (exact at these sizes), each row with a number of its own.
_VECTORS = """
SELECT row_number() OVER () AS row, vec_id, label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
FROM embeddings
WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF isfinite(x)]) = 64"""


def _codes_sql(rounds: int = 2) -> str:
    """Product codes: every round compares all parts with all entries of their codebook."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
    SELECT row, p, min((list_inner_product(x.v, x.v) - 2 * list_inner_product(x.v, b.v) + list_inner_product(b.v, b.v)) * 64 + e) AS best
    FROM x JOIN b{r} AS b USING (p) GROUP BY row, p)""")
        if r < rounds:
            steps.append(f"""m{r} AS (
    SELECT p, e, list(mean ORDER BY i) AS v FROM (
        SELECT p, CAST(best AS BIGINT) % 64 AS e, i, floor(sum(v[i]) / count(*)) AS mean
        FROM a{r} JOIN x USING (row, p), range(1, 5) AS t(i) GROUP BY ALL) GROUP BY p, e),
b{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM b{r} AS b LEFT JOIN m{r} AS m USING (p, e))""")
    return f"""
WITH vectors AS MATERIALIZED ({_VECTORS}),
x AS MATERIALIZED (SELECT row, p, v[4 * p + 1:4 * p + 4] AS v FROM vectors, range(16) AS t(p)),
starts AS (SELECT row, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM vectors ORDER BY e LIMIT 64),
b0 AS MATERIALIZED (SELECT p, e, v FROM x JOIN starts USING (row)),
{", ".join(steps)},
coded AS (
    SELECT row, string_agg(format('{{:02x}}', CAST(best AS BIGINT) % 64), '' ORDER BY p) AS code,
        CAST(sum(CAST(best AS BIGINT) // 64) AS BIGINT) AS error
    FROM a{rounds} GROUP BY row),
labels AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN vectors USING (row) GROUP BY label),
books AS (
    SELECT sha256(string_agg(CAST(CAST(v[i] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
    FROM b{rounds}, range(1, 5) AS t(i))
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM coded JOIN vectors USING (row) JOIN labels ON labels.label IS NOT DISTINCT FROM vectors.label, books
"""


def _clusters_sql(rounds: int = 5) -> str:
    """Clusters: every round compares all vectors with all centroids."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
    SELECT row, min((list_inner_product(x.v, x.v) - 2 * list_inner_product(x.v, b.v) + list_inner_product(b.v, b.v)) * 40 + e) AS best
    FROM x, b{r} AS b GROUP BY row)""")
        if r < rounds:
            steps.append(f"""m{r} AS (
    SELECT e, list(mean ORDER BY i) AS v FROM (
        SELECT CAST(best AS BIGINT) % 40 AS e, i, floor(sum(v[i]) / count(*)) AS mean
        FROM a{r} JOIN x USING (row), range(1, 65) AS t(i) GROUP BY ALL) GROUP BY e),
b{r + 1} AS MATERIALIZED (SELECT b.e, coalesce(m.v, b.v) AS v FROM b{r} AS b LEFT JOIN m{r} AS m USING (e))""")
    return f"""
WITH x AS MATERIALIZED ({_VECTORS}),
b0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)), v) - 1 AS e, v FROM x ORDER BY e LIMIT 40),
{", ".join(steps)},
found AS (SELECT row, CAST(best AS BIGINT) % 40 AS cluster, CAST(best AS BIGINT) // 40 AS distance FROM a{rounds})
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
    CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
    CAST(sum(distance) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string([CAST(CAST(c AS BIGINT) AS VARCHAR) FOR c IN b.v], ',')) AS centroid_sha256
FROM found JOIN x USING (row) JOIN b{rounds} AS b ON b.e = cluster
"""


ORACLE: dict[str, str] = {
    "op11_codes": _codes_sql(),
    "op13_clusters": _clusters_sql(),
    "op2_quality": r"""
WITH d AS (SELECT doc_id, source, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d WHERE text IS NOT NULL),
own AS (
    SELECT *, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
    FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
texts AS (SELECT source, count(DISTINCT text) AS n FROM d GROUP BY source),
bad AS (
    SELECT o.source, norm FROM own o JOIN texts t ON o.source IS NOT DISTINCT FROM t.source
    GROUP BY o.source, norm, t.n HAVING count(DISTINCT text) >= 20 AND count(DISTINCT text) > 0.1 * t.n),
by_line AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS dup,
        coalesce(sum(len(string_split(o.norm, ' '))) FILTER (WHERE b.norm IS NOT NULL), 0) AS gone
    FROM own o LEFT JOIN bad b ON o.norm = b.norm AND o.source IS NOT DISTINCT FROM b.source GROUP BY doc_id),
windows AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (
    SELECT doc_id, count(DISTINCT pos) AS n
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM windows WHERE n > 1) GROUP BY doc_id),
base AS (
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(gone, 0) AS BIGINT) AS n_removed_words
    FROM d LEFT JOIN by_line USING (doc_id) LEFT JOIN again USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_removed_words <= 0.5 * n_words AS kept
FROM base
""",
    "op4_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS size
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes),
hits AS (
    SELECT doc_id, i, p.size, item_id FROM places p JOIN windows v ON v.win = array_to_string(w[i:i + p.size - 1], ' ')),
covered AS (
    SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM hits) GROUP BY doc_id),
found AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(found.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(covered.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
""",
    "op8_fixity": rf"""
WITH records AS (
    SELECT page_id, 'WARC/1.0' || e || 'WARC-Type: resource' || e || 'WARC-Target-URI: ' || coalesce(url, '') || e
        || 'Content-Type: text/html' || e || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR) || e || e
        || coalesce(html, '') || e || e AS record
    FROM pages, (SELECT chr(13) || chr(10) AS e)),
placed AS (
    SELECT page_id, CAST(strlen(record) AS BIGINT) AS length, sha256(record) AS digest,
        CAST(coalesce(sum(strlen(record)) OVER (ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
    FROM records)
SELECT page_id, start // {fixity.FILE_BYTES} AS file, start % {fixity.FILE_BYTES} AS "offset", length,
    CASE page_id % {DAMAGE} WHEN 7 THEN 'missing' ELSE 'changed' END AS kind, digest AS digest_a,
    CASE page_id % {DAMAGE} WHEN 7 THEN '' ELSE sha256(digest || '!') END AS digest_b
FROM placed WHERE page_id % {DAMAGE} IN (3, 7)
""",
}
