"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from martstar.llm.chunk_dedup import chunk_dedup
from martstar.llm.common import python_workers, table
from martstar.llm.conversation_repair import repair_damaged
from martstar.llm.decontaminate import leaks
from martstar.llm.exact_dedup import exact_groups
from martstar.llm.hard_negatives import positives_and_negatives
from martstar.llm.html_consensus import host_paths, main_text
from martstar.llm.lang_id import languages
from martstar.llm.lang_id import train as train_languages
from martstar.llm.license_scan import license_scan
from martstar.llm.packing import pack
from martstar.llm.sharding import shards
from martstar.llm.simhash_dedup import near_groups
from martstar.llm.suffix_dedup import suffix_dedup
from martstar.llm.toxicity import scores, train


def op1_suffix_dedup(spark, sf_dir):
    python_workers(spark)
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op2_license_scan(spark, sf_dir):
    return license_scan(table(spark, sf_dir, "documents"))


def op3_language_id(spark, sf_dir):
    python_workers(spark)
    docs = table(spark, sf_dir, "documents")
    return languages(docs, train_languages(docs))


def op4_simhash_dedup(spark, sf_dir):
    python_workers(spark)
    return near_groups(table(spark, sf_dir, "documents"))


def op5_chunk_dedup(spark, sf_dir):
    python_workers(spark)
    return chunk_dedup(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark, sf_dir):
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark, sf_dir):
    python_workers(spark)
    pages = table(spark, sf_dir, "pages")
    return main_text(pages, host_paths(pages))


def op9_toxicity(spark, sf_dir):
    python_workers(spark)
    docs = table(spark, sf_dir, "documents")
    return scores(docs, train(docs, table(spark, sf_dir, "labels")))


def op10_packing(spark, sf_dir):
    python_workers(spark)
    return pack(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark, sf_dir):
    python_workers(spark)
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return positives_and_negatives(table(spark, sf_dir, "embeddings"), noisy)


def op12_sharding(spark, sf_dir):
    python_workers(spark)
    text = F.coalesce("doc.text", F.lit("")).cast("binary")
    return shards(table(spark, sf_dir, "documents")).select(
        "doc.doc_id", "size", F.crc32(text).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_conversation_repair(spark, sf_dir):
    python_workers(spark)
    return repair_damaged(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_license_scan, op3_language_id, op4_simhash_dedup, op5_chunk_dedup,
    op6_decontaminate, op7_exact_dedup, op8_html_extraction, op9_toxicity, op10_packing,
    op11_hard_negatives, op12_sharding, op13_conversation_repair,
)}

# unsigned CRC-32 in SQL: the table of the polynomial, then one step per byte of {text}
_CRC_TABLE = """
          SELECT list(c ORDER BY n) AS tab FROM (
            SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, k:
                     CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
            FROM range(256) r(n))"""
_CRC = """xor(4294967295, list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode({text})), '..'),
                                                            lambda x: ('0x' || x)::BIGINT)),
            lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])))"""

SQL = {
    "op11_hard_negatives": """
        WITH v AS (
          SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT a.n AS anchor, a.vec_id AS anchor_id, a.label = b.label AS same, b.n, b.vec_id,
                 list_inner_product(a.e, b.e)::BIGINT AS score
          FROM v a JOIN v b ON a.n <> b.n WHERE a.vec_id % 100 = 0),
        p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, p.vec_id AS positive_id,
               (row_number() OVER (PARTITION BY p.anchor, p.n ORDER BY s.score DESC, s.vec_id))::INT AS rank,
               s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
        FROM p JOIN s USING (anchor)
        WHERE NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
        QUALIFY rank <= 5""",
    # the same grammar as a walk over its states, row by row
    "op13_conversation_repair": f"""
        WITH RECURSIVE crc AS ({_CRC_TABLE}),
        raw AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
        kinds AS (SELECT raw.*, {_CRC.format(text="name")} % 20 AS kind FROM raw, crc),
        damaged AS (
          SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
                 CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                 unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
          FROM kinds),
        placed AS (
          SELECT *, coalesce(conv_id, -1) AS conv, left(role, 1) AS i,
                 rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
          FROM damaged),
        copied AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS copies FROM placed),
        faulty AS (
          SELECT *, CASE WHEN core = '' THEN 'blank' WHEN copies > 1 THEN 'duplicate'
                         WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                 lag(i) OVER (PARTITION BY conv_id ORDER BY pos) || i AS pair
          FROM copied),
        counted AS (
          SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                 count(*) FILTER (fault = 'truncated') AS truncated,
                 count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
          FROM faulty GROUP BY conv),
        ins(p, q, lines) AS (VALUES (0, 0, []::VARCHAR[]), (0, 2, ['user:']), (0, 3, ['user:', 'assistant:']),
          (1, 1, []), (1, 2, ['user:']), (1, 3, ['user:', 'assistant:']), (2, 2, []), (2, 3, ['assistant:']),
          (3, 3, []), (3, 2, ['user:'])),
        due(p, q, role) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
        step(p, i, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
        edit AS (
          SELECT conv, pos, p, p AS q, 2 AS cost, 'D' AS letter, []::VARCHAR[] AS lines FROM faulty, due
          UNION ALL
          SELECT conv, pos, p, q, 1 + 5 * (fault = 'truncated')::INT, 'R', [due.role || ':' || text]
          FROM faulty, due WHERE fault IN ('', 'truncated')
          UNION ALL
          SELECT conv, pos, p, q, 5 * (fault = 'truncated')::INT, 'K', [role || ':' || text]
          FROM faulty JOIN step USING (i) WHERE fault IN ('', 'truncated')),
        best AS (
          SELECT conv, 0::BIGINT AS pos, 0 AS p, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}} AS x FROM counted
          UNION ALL
          SELECT b.conv, e.pos, e.q,
                 min({{'cost': x.cost + 5 * len(ins.lines)::INT + e.cost, 'audit': x.audit || repeat('I', len(ins.lines)) || letter,
                      'lines': x.lines || ins.lines || e.lines}})
          FROM best b JOIN ins USING (p) JOIN edit e ON e.conv = b.conv AND e.pos = b.pos + 1 AND e.p = ins.q
          GROUP BY b.conv, e.pos, e.q),
        done AS (
          SELECT c.conv, min({{'cost': x.cost + 5 * len(ins.lines)::INT, 'audit': x.audit || repeat('I', len(ins.lines)),
                              'lines': x.lines || ins.lines}}) AS x
          FROM counted c JOIN best b ON b.conv = c.conv AND b.pos = c.n JOIN ins USING (p) WHERE ins.q IN (0, 3)
          GROUP BY c.conv)
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(x.cost, 0)::BIGINT AS cost,
               coalesce(x.audit, '') AS audit, sha256(coalesce(array_to_string(x.lines, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id, coalesce(conv_id, -1) AS conv FROM conversations) o
        LEFT JOIN counted USING (conv) LEFT JOIN done USING (conv)""",
    "op12_sharding": f"""
        WITH crc AS ({_CRC_TABLE}),
        d AS (
          SELECT doc_id, coalesce(text, '') AS t, octet_length(encode(coalesce(text, ''))) + 1 AS size FROM documents),
        o AS (
          SELECT *, row_number() OVER w AS n, coalesce(sum(size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
          FROM d WINDOW w AS (ORDER BY md5(t), doc_id NULLS LAST)),
        places AS (SELECT below FROM o UNION SELECT sum(size) FROM d),
        cut AS (
          SELECT j, arg_min(below, (abs(16 * below - j * (SELECT sum(size) FROM d)), below)) AS border
          FROM places, range(1, 16) r(j) GROUP BY j),
        s AS (SELECT o.*, (SELECT count(*) FROM cut WHERE border <= below) AS shard FROM o)
        SELECT doc_id, size, {_CRC.format(text="t")} AS text_crc32, 'bytes' AS law, shard::INT AS shard,
               row_number() OVER (PARTITION BY shard ORDER BY n) - 1 AS slot, NULL::INT AS grown_shard
        FROM s, crc""",
    "op7_exact_dedup": r"""
        WITH d AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM d WINDOW g AS (PARTITION BY t)""",
}
