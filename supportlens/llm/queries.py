"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from supportlens.llm import cover_tree, exact_dedup, licenses, mixing, packing, pii, quality_gam, simhash, slots, spelling, token_files, warc, whitening
from supportlens.llm.common import let_workers_import


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op6_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slots.shard_documents(_read(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_read(spark, sf_dir, "documents"), digest=True).drop("text_hash")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(_read(spark, sf_dir, "documents"))


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = quality_gam.train(docs, _read(spark, sf_dir, "labels"))
    return quality_gam.scored(docs, model).select("doc_id", "held_out", "score", "predicted")


def op2_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op3_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op4_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_read(spark, sf_dir, "documents"))


def op5_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"))


def op8_pii_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(_read(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_round_trip(_read(spark, sf_dir, "documents"))


def op11_jacobi_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"))


def op12_spelling_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_forms(_read(spark, sf_dir, "documents"))


def op13_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_read(spark, sf_dir, "pages"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_gam, op2_simhash_pivots, op3_cover_tree, op4_license_diagonals, op5_complement_packing, op6_virtual_slots,
        op7_exact_dedup, op8_pii_field, op9_token_files, op10_mixing, op11_jacobi_whitening, op12_spelling_forms,
        op13_warc_archives,
    )
}

_SPACES = r"[\x20\x09-\x0D]"
_UPPER = string.ascii_uppercase
_ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
#: As many ASCII characters that aren't lower-case letters, without the quote.
_SINGLE = "".join(c for c in map(chr, range(0x20, 0x7F)) if not c.islower() and c != "'")[: len(_ACCENTED)]

ORACLE = {
    "op3_cover_tree": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        links AS (
            SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id
            WHERE list_cosine_similarity(x.e, y.e) >= 0.9),
        reach AS (
            SELECT vec_id, vec_id AS root FROM v UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.vec_id),
        least AS (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id),
        counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM least LEFT JOIN counts ON a = vec_id""",
    "op12_spelling_forms": rf"""
        WITH RECURSIVE crc AS (
            SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
                        ORDER BY i) AS steps FROM range(256) t(i)),
        runs AS (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
                   unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{{6,}}')) AS run
            FROM documents),
        counted AS (SELECT id, translate(run, '{_UPPER}', '{_UPPER.lower()}') AS run, count(*) AS n FROM runs GROUP BY ALL),
        bytes AS (SELECT *, hex(encode(id || ':' || run)) AS h FROM counted),
        summed AS (
            SELECT run, n, xor(4294967295, list_reduce(
                       list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
                       lambda a, b: xor(a >> 8, steps[1 + (xor(a, b) & 255)]), 4294967295)) AS h
            FROM bytes, crc),
        made AS (
            SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
            FROM summed),
        words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
        -- One byte a letter, since the distance counts bytes.
        spelt AS (SELECT *, translate(word, '{_ACCENTED}', '{_SINGLE}') AS s, length(word) AS l FROM words),
        pairs AS (
            SELECT x.word, x.n, y.word AS other, y.n AS other_n FROM spelt x JOIN spelt y ON y.l BETWEEN x.l - 1 AND x.l + 1
            WHERE levenshtein(x.s, y.s) = 1),
        best AS (
            SELECT word, n, count(*) AS n_near, max(other_n) AS most, arg_min(other, (-other_n, other)) AS other FROM pairs GROUP BY ALL),
        near AS (
            SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * words.n THEN other END AS form,
                   CASE WHEN most >= 5 * words.n THEN most END AS form_n
            FROM words LEFT JOIN best USING (word)),
        ways AS (
            SELECT word, word AS root, 0 AS step FROM near
            UNION ALL SELECT w.word, near.form, step + 1 FROM ways w JOIN near ON near.word = w.root WHERE near.form IS NOT NULL),
        ends AS (SELECT word, arg_max(root, step) AS root FROM ways GROUP BY word)
        SELECT near.word, form, root, n, n_near, form_n FROM near JOIN ends USING (word)""",
    "op13_warc_archives": """
        WITH p AS (
            SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
        r AS (
            SELECT *, payload_bytes >= 1000 AS long, row_number() OVER w AS place, first(page_id) OVER w AS last
            FROM p WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST))
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN long AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN long AND place > 1 THEN last END AS refers_to
        FROM r""",
    "op7_exact_dedup": rf"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   sha256(regexp_replace(coalesce(text, ''), '{_SPACES}', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, first(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER w = 1 AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST)""",
    "op10_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source,
                   CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
            FROM documents),
        sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
        weighed AS (
            SELECT *, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight,
                   CAST(2 * source_size AS DOUBLE) AS most, CAST(1.5 * sum(source_size) OVER () AS DOUBLE) AS words
            FROM sums),
        levelled AS (
            SELECT *, coalesce(sum(most) OVER before, 0) AS used,
                   sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight
            FROM weighed
            WINDOW before AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        marked AS (SELECT *, most * open_weight <= weight * (words - used) AS capped FROM levelled),
        targets AS (
            SELECT source, source_size,
                   CASE WHEN capped THEN most ELSE weight
                       * (words - sum(CASE WHEN capped THEN most ELSE 0 END) OVER ())
                       / nullif(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER (), 0) END AS target
            FROM marked),
        rated AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets),
        drawn AS (
            SELECT s.doc_id, s.size, s.source, r.source_size, r.target, k.seed,
                   CAST(floor(rate) AS BIGINT) + CAST(CAST('0x' || substr(md5(concat_ws(':', k.seed, coalesce(s.source, ''),
                       coalesce(CAST(s.doc_id AS VARCHAR), ''))), 1, 13) AS BIGINT) / 4503599627370496.0 < rate - floor(rate)
                       AS BIGINT) AS copies
            FROM sized s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source, range(16) k(seed)),
        tried AS (
            SELECT source, seed, abs(CAST(sum(size * copies) AS DOUBLE) - any_value(target)) AS off
            FROM drawn GROUP BY source, seed),
        best AS (SELECT source, arg_min(seed, (off, seed)) AS seed FROM tried GROUP BY source)
        SELECT d.doc_id, d.size, d.source_size, d.target, d.size * d.copies AS taken, d.copies
        FROM drawn d JOIN best b ON d.source IS NOT DISTINCT FROM b.source AND d.seed = b.seed""",
}
