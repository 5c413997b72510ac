"""The registered queries of this subpackage and their expected results as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.scratch import scratch_folder
from . import language_id, quality
from .common import in_held_out, table, utf8
from .decontamination import find_leaks
from .exact_dedup import exact_duplicates
from .filter_audit import audit_filters
from .jaccard_join import similar_documents
from .licenses import scan_licenses
from .line_dedup import drop_repeated_runs
from .packing import pack_documents
from .sharding import assign_shards
from .simhash import near_duplicates
from .vector_codes import compress_vectors
from .warc import read_archives, write_archives

SHARDS = 8


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without later copies of repeated runs of lines."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    counted = docs.select("doc_id", "text", F.size(F.split(text, "\n")).cast("long").alias("lines"))
    left = drop_repeated_runs(counted)
    cut = F.size(F.split(text, "\n")).cast("long")
    return left.select(
        "doc_id",
        "lines",
        F.when(F.octet_length(text) == 0, F.lit(0).cast("long")).otherwise(cut).alias("lines_left"),
        F.sha2(text.cast("binary"), 256).alias("text_sha256"),
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = in_held_out(F.col("doc_id"))
    model = language_id.train(docs.filter(~held_out))
    found = language_id.identify_languages(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = utf8(F.col("text"))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return assign_shards(rows, "doc_id", [1.0] * SHARDS, [1.0] * (SHARDS + 1))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = f"{scratch_folder(spark)}/archives"
    write_archives(table(spark, sf_dir, "pages"), archives)
    return read_archives(spark, archives)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = in_held_out(F.col("doc_id"))
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    scored = quality.score_documents(docs, quality.train(docs.filter(~held_out), labels))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words_in_shingle=4, distance=4)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(table(spark, sf_dir, "embeddings"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"), words_in_shingle=3, percent=90)


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_exact_dedup, op3_language_id, op4_license_scan, op5_sharding,
        op6_decontamination, op7_warc, op8_quality, op9_packing, op10_simhash, op11_filter_audit,
        op12_vector_codes, op13_jaccard_join,
    )
}



def _expected_codes(parts: int = 8, width: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The codes of ``op12_vector_codes`` by comparing every entry in every round."""
    means = ", ".join(f"(sum(cells[{j}]) - (sum(cells[{j}]) % count(*) + count(*)) % count(*)) // count(*)" for j in range(1, width + 1))
    ctes = [
        f"""cells AS MATERIALIZED (
            SELECT vec_id, label, part::INT AS part,
                   list_transform(embedding[part * {width} + 1 : part * {width} + {width}], lambda x: floor(4096 * x)::BIGINT) AS cells
            FROM embeddings, range({parts}) r(part)
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        )""",
        f"""book0 AS MATERIALIZED (
            SELECT part, row_number() OVER w - 1 AS entry, cells AS e FROM cells
            WINDOW w AS (PARTITION BY part ORDER BY vec_id) QUALIFY entry < {entries}
        )""",
    ]
    for turn in range(rounds + 1):
        ctes.append(
            f"""near{turn} AS MATERIALIZED (
            SELECT vec_id, part, any_value(label) AS label, any_value(cells) AS cells,
                   min({{'d': list_sum(list_transform(range(1, {width + 1}),
                       lambda j: (cells[j] - e[j]) * (cells[j] - e[j])))::BIGINT, 'k': entry}}) AS best
            FROM cells JOIN book{turn} USING (part) GROUP BY vec_id, part
        )"""
        )
        if turn < rounds:
            ctes.append(
                f"""book{turn + 1} AS MATERIALIZED (
            SELECT b.part, b.entry, coalesce(n.e, b.e) AS e
            FROM book{turn} b LEFT JOIN (
                SELECT part, best.k AS entry, [{means}] AS e FROM near{turn} GROUP BY part, best.k
            ) n ON n.part = b.part AND n.entry = b.entry
        )"""
            )
    return f"""
        WITH {", ".join(ctes)}, coded AS (
            SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best.k), '' ORDER BY part) AS code,
                   sum(best.d)::BIGINT AS error
            FROM near{rounds} GROUP BY vec_id
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM book{rounds}) AS codebooks_sha256
        FROM coded
    """


EXPECTED = {
    "op1_line_dedup": r"""
        WITH split AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
        ), lines AS (
            SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS line_no FROM split
        ), worded AS (
            SELECT *, row_number() OVER w AS idx, sum(words) OVER w AS total
            FROM (
                SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM lines
            )
            WHERE words > 0
            WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)
        ), runs AS (
            SELECT a.doc_id, a.idx AS first, b.idx AS last
            FROM worded a JOIN worded b ON a.doc_id = b.doc_id AND a.idx <= b.idx
            WHERE b.total - a.total + a.words >= 50
              AND (b.total - b.words - a.total + a.words < 50 OR b.total - a.total < 50)
        ), content AS (
            SELECT r.doc_id, r.first, r.last, string_agg(w.line, chr(10) ORDER BY w.idx) AS text
            FROM runs r JOIN worded w ON w.doc_id = r.doc_id AND w.idx BETWEEN r.first AND r.last
            GROUP BY ALL
        ), later AS (
            SELECT doc_id, first, last
            FROM content
            QUALIFY (doc_id, first) > min((doc_id, first)) OVER (PARTITION BY text)
        ), worded_gone AS (
            SELECT DISTINCT w.doc_id, w.idx, w.line_no
            FROM worded w JOIN later r ON w.doc_id = r.doc_id AND w.idx BETWEEN r.first AND r.last
        ), gone AS (
            SELECT doc_id, line_no FROM worded_gone
            UNION ALL  -- lines without a word go between two lines that go
            SELECT l.doc_id, l.line_no
            FROM worded_gone a
            JOIN worded_gone b ON a.doc_id = b.doc_id AND b.idx = a.idx + 1
            JOIN lines l ON l.doc_id = a.doc_id AND l.line_no > a.line_no AND l.line_no < b.line_no
        ), kept AS (
            SELECT l.doc_id, coalesce(string_agg(l.line, chr(10) ORDER BY l.line_no), '') AS text,
                   count(*) AS lines_left
            FROM lines l ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.line_no = g.line_no
            GROUP BY l.doc_id
        )
        SELECT s.doc_id, len(s.parts)::BIGINT AS lines,
               CASE WHEN coalesce(k.text, '') = '' THEN 0 ELSE k.lines_left END::BIGINT AS lines_left,
               sha256(coalesce(k.text, '')) AS text_sha256
        FROM split s LEFT JOIN kept k USING (doc_id)
    """,
    "op2_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
            FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
               sha256(norm) AS text_sha256
        FROM n
    """,
    "op7_warc": r"""
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload,
                   min(page_id) OVER (PARTITION BY coalesce(html, '')) AS holder
            FROM pages
        ), bits AS (
            SELECT *, sha1(payload) AS hex FROM p
        )
        SELECT page_id,
               strlen(payload)::BIGINT AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                       1 + (((('0x' || substr(hex, 1 + 10 * (i // 8), 10))::BIGINT
                             >> (35 - 5 * (i % 8))) & 31))::INTEGER, 1)), '') AS payload_digest,
               CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = holder THEN NULL ELSE holder END AS refers_to,
               true AS whole
        FROM bits
    """,
    "op11_filter_audit": r"""
        WITH text_of AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
        ), marked AS (
            SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
            FROM labels GROUP BY doc_id
        ), judged AS (
            SELECT part, good, toxic, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
                   100 * len(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * len(t) AS c,
                   regexp_matches(t, '[#$%&*|]') AS d,
                   doc_id > min(doc_id) OVER (PARTITION BY t) AS e
            FROM text_of LEFT JOIN marked USING (doc_id)
        ), patterns AS (
            SELECT part,
                   (len(words) < 50)::INT + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::INT
                   + 4 * c::INT + 8 * d::INT + 16 * e::INT AS failed,
                   count(*) AS docs, count_if(good) AS good, count_if(toxic) AS toxic
            FROM judged GROUP BY ALL
        ), letters AS (
            SELECT substr('ABCDE', i, 1) AS letter, (1 << (i - 1))::INT AS bit FROM range(1, 6) r(i)
        ), steps AS (
            SELECT concat(v.letter, w.letter, x.letter, y.letter, z.letter) AS filter_order, step::INT AS step,
                   [v.letter, w.letter, x.letter, y.letter, z.letter][step] AS filter,
                   [v.bit, w.bit, x.bit, y.bit, z.bit][step] AS own,
                   list_sum([0, v.bit, w.bit, x.bit, y.bit, z.bit][1:step])::INT AS before
            FROM letters v, letters w, letters x, letters y, letters z, range(1, 6) r(step)
            WHERE v.bit + w.bit + x.bit + y.bit + z.bit = 31
              AND v.bit | w.bit | x.bit | y.bit | z.bit = 31
        ), counted AS (
            SELECT part, filter_order, step, filter,
                   sum(docs) FILTER (failed & (before | own) = 0) AS kept,
                   sum(docs) FILTER (failed & own > 0 AND failed & before = 0) AS removed,
                   sum(docs) FILTER (failed & own > 0 AND failed & before > 0) AS redundant,
                   sum(docs) FILTER (failed = own) AS unique_fails,
                   sum(good) FILTER (failed & own > 0 AND failed & before = 0) AS good_lost,
                   sum(toxic) FILTER (failed & own > 0 AND failed & before = 0) AS toxic_lost
            FROM patterns, steps GROUP BY ALL
        )
        SELECT part, filter_order, step, filter,
               coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
               coalesce(redundant, 0)::BIGINT AS redundant,
               coalesce(unique_fails, 0)::BIGINT AS unique_fails,
               coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
               coalesce(sum(removed) OVER (PARTITION BY part, filter), 0)::BIGINT AS shapley
        FROM counted
    """,
    "op12_vector_codes": _expected_codes(),
    "op13_jaccard_join": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), sets AS MATERIALIZED (
            SELECT doc_id, list_distinct(CASE
                WHEN len(w) = 0 THEN []
                WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 2]))
            END) AS shingles
            FROM worded
        ), elements AS MATERIALIZED (
            SELECT doc_id, len(shingles) AS size, unnest(shingles) AS shingle FROM sets
        ), pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.size + b.size) - count(*) AS all_of_both, count(*) AS shared
            FROM elements a JOIN elements b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
            GROUP BY a.doc_id, b.doc_id
        ), links AS MATERIALIZED (
            SELECT a, b FROM pairs WHERE 100 * shared >= 90 * all_of_both
            UNION ALL SELECT b, a FROM pairs WHERE 100 * shared >= 90 * all_of_both
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM sets
            UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ), lowest AS (
            SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
        )
        SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id FROM sets JOIN lowest USING (doc_id)
    """,
}
