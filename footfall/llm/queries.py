"""The operators' queries: each over its whole table, with the parameters meant for use."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from footfall.llm import (
    bpe, embeddings, filters, language, minhash, mixing, pii, runs, sharding, token_counts, topk, toxicity, warc,
)
from footfall.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Settings(words=2))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), path)


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.learn(docs, labels))


@query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.learn(docs))


@query
def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


@query
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(table(spark, sf_dir, "documents"))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


ORACLE["op2_minhash"] = """
    WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(regexp_split_to_array(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'
        ), lambda w: w <> '') AS w FROM documents
    ), sets AS (
        SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM words WHERE len(w) > 0)
    ), sizes AS (
        SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
    ), shared AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id < y.doc_id
        GROUP BY 1, 2
    ), links AS (
        SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
        WHERE 100 * c >= 80 * (p.n + q.n - c)
    ), reach AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION
        SELECT r.a, l.b FROM reach r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON l.a = r.b
    )
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
    FROM documents d LEFT JOIN sizes USING (doc_id)
    JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""

ORACLE["op1_mixing"] = """
    WITH sizes AS (
        SELECT doc_id, source, coalesce('0' || source, '1') AS k, md5('mix|' || coalesce(doc_id::VARCHAR, '')) AS place,
            coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
        FROM documents
    ), sources AS (
        SELECT k, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY k) - 1) % 3 + 1)::DOUBLE AS weight
        FROM sizes GROUP BY k
    ), rise AS (
        SELECT *, (3 * source_size)::DOUBLE AS room,
            ((SELECT sum(size) FROM sizes) - coalesce(sum((3 * source_size)::DOUBLE) OVER (
                ORDER BY 3 * source_size / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY 3 * source_size / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rise
        FROM sources
    ), level AS (
        SELECT arg_min(rise, room / weight) AS level FROM rise WHERE rise <= room / weight
    ), plan AS (
        SELECT k, source_size, least(room, level * weight) AS target FROM rise, level
    ), stretch AS (
        SELECT *, sum(target) OVER (ORDER BY k) AS high, floor(target)::BIGINT // greatest(source_size, 1) * ceil(source_size / 2048)
                + ceil(floor(target)::BIGINT % greatest(source_size, 1) / 2048) AS quota,
            round(sum(target) OVER ()) AS total FROM plan
    ), drawn AS (
        SELECT slot, slot * 0.6180339887498949::DOUBLE - floor(slot * 0.6180339887498949::DOUBLE) AS x FROM (
            SELECT unnest(range(1, (SELECT ceil(max(total) / 2048)::BIGINT + 1 FROM stretch))) AS slot)
    ), held AS (
        SELECT k, slot, row_number() OVER (PARTITION BY k ORDER BY slot) - 1 AS rank, quota
        FROM drawn JOIN stretch ON target >= 1 AND (high - target) / total <= x AND x < high / total
    ), slots AS (
        SELECT k, slot, rank FROM held WHERE rank < quota
        UNION ALL
        SELECT k, rank + 1 + ceil(total / 2048)::BIGINT, rank FROM (
            SELECT k, total, unnest(range(coalesce(got, 0), quota::BIGINT)) AS rank
            FROM stretch LEFT JOIN (SELECT k, count(*) AS got FROM held GROUP BY k) USING (k) WHERE target >= 1)
    ), stream AS (
        SELECT *, sum(size) OVER (PARTITION BY k ORDER BY place, size, doc_id) - size AS start FROM sizes
    ), pieces AS (
        SELECT k, place, slot FROM stream JOIN stretch USING (k) JOIN slots USING (k)
        WHERE size > 0 AND start // 2048 <= rank % ceil(source_size / 2048) AND (start + size - 1) // 2048 >= rank % ceil(source_size / 2048)
    ), firsts AS (
        SELECT k, place, min(slot)::BIGINT AS first_slot FROM pieces GROUP BY ALL
    ), taken AS (
        SELECT k, doc_id, source, size, place, source_size, target, (floor(target)::BIGINT // greatest(source_size, 1)) * size
            + greatest(least(floor(target)::BIGINT % greatest(source_size, 1) - start, size), 0) AS taken
        FROM stream JOIN plan USING (k)
    )
    SELECT doc_id, source, size, source_size, target, taken::BIGINT AS taken, CASE WHEN taken > 0 THEN first_slot END AS first_slot
    FROM taken LEFT JOIN firsts USING (k, place)
"""
ORACLE["op10_sharding"] = """
    WITH RECURSIVE table_step(i, b, c) AS (
        SELECT i, 0, i::BIGINT FROM (SELECT unnest(range(256)) AS i)
        UNION ALL
        SELECT i, b + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM table_step WHERE b < 8
    ), crc_table AS (
        SELECT list(c ORDER BY i) AS t FROM table_step WHERE b = 8
    ), keyed AS (
        SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 1 AS size, md5(coalesce(text, '')) AS text_md5
        FROM documents
    ), placed AS (
        SELECT doc_id, text, size, least(floor((sum(size) OVER (ORDER BY text_md5, doc_id) - size / 2) * 16
            / sum(size) OVER ()), 15)::INT AS shard, text_md5 FROM keyed
    )
    SELECT doc_id, size::BIGINT AS size, xor(4294967295, list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT)),
            lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])
        )) AS text_crc32, 'bytes' AS law, shard,
        (row_number() OVER (PARTITION BY shard ORDER BY text_md5, doc_id) - 1)::BIGINT AS slot, NULL::INT AS grown_shard
    FROM placed, crc_table
"""
ORACLE["op7_embeddings"] = """
    WITH RECURSIVE valid AS (
        SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE len(embedding) > 0
            AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
            AND len(list_filter(embedding, lambda c: c <> 0)) > 0
    ), links AS (
        SELECT p.vec_id AS a, q.vec_id AS b FROM valid p JOIN valid q ON p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
        WHERE list_cosine_similarity(p.x, q.x) >= 0.9
    ), reach AS (
        SELECT vec_id AS a, vec_id AS b FROM embeddings
        UNION
        SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
    )
    SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
    FROM embeddings e JOIN (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a) USING (vec_id)
    LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
"""
ORACLE["op9_top_k"] = """
    WITH valid AS (
        SELECT vec_id, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)) AS x FROM embeddings WHERE len(embedding) > 0
            AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
        FROM valid q JOIN valid c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 100 = 0
    )
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
    FROM scored QUALIFY rank <= 10
"""
ORACLE["op13_warc"] = """
    WITH p AS (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
    ), q AS (
        SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
    )
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
        CASE WHEN first IS DISTINCT FROM page_id AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
    FROM q
"""
ORACLE["op12_filter_audit"] = """
    WITH RECURSIVE orders(o, n) AS (
        SELECT '', 0
        UNION ALL
        SELECT o || f, n + 1 FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f) WHERE n < 5 AND NOT contains(o, f)
    ), texts AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
            regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
    ), marked AS (
        SELECT doc_id, part, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good,
            doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic,
            concat(
                CASE WHEN len(w) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
                CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text) THEN 'C' END,
                CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
                CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' END
            ) AS fails
        FROM texts
    ), patterns AS (
        SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
        FROM marked GROUP BY ALL
    ), steps AS (
        SELECT part, o AS filter_order, step::INT AS step, o[step] AS f, fails, patterns.n AS n, good, toxic, contains(fails, o[step]) AS fail,
            translate(fails, o[1:step - 1], '') <> fails AS gone
        FROM orders, (SELECT unnest(range(1, 6)) AS step), patterns WHERE orders.n = 5
    ), counted AS (
        SELECT part, filter_order, step, f, sum(CASE WHEN NOT fail AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
            sum(CASE WHEN fail AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN fail AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
            sum(CASE WHEN fails = f THEN n ELSE 0 END)::BIGINT AS unique_fails,
            sum(CASE WHEN fail AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost,
            sum(CASE WHEN fail AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
        FROM steps GROUP BY ALL
    )
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
        (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
    FROM counted
"""
ORACLE["op11_periodic_runs"] = """
    WITH RECURSIVE table_step(i, b, c) AS (
        SELECT i, 0, i::BIGINT FROM (SELECT unnest(range(256)) AS i)
        UNION ALL
        SELECT i, b + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM table_step WHERE b < 8
    ), crc_table AS (
        SELECT list(c ORDER BY i) AS t FROM table_step WHERE b = 8
    ), split AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, xor(4294967295, list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT)),
            lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]))) AS h
        FROM documents, crc_table
    ), placed AS (
        SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS echoed, (h // 10) % greatest(len(w), 1) AS a, (h // 10) % 8 AS g FROM split
    ), changed AS (
        SELECT doc_id, n, CASE WHEN echoed THEN list_transform(range(n),
            lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g)) END]) ELSE w END AS w FROM placed
    ), words AS (
        SELECT doc_id, i, w[i + 1] AS w FROM (SELECT doc_id, w, unnest(range(n)) AS i FROM changed)
    ), equal AS (
        SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.w = y.w AND x.i < y.i
    ), stretches AS (
        SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (
            SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal)
        GROUP BY doc_id, q, island HAVING count(*) >= greatest(q, 12 - q)
    ), runs AS (
        SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY ALL
    ), gone AS (
        SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
    ), collapsed AS (
        SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
    ), listed AS (
        SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS r,
            arg_min([start, length, period], [-length, start, period]) AS best
        FROM runs GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best[1]::BIGINT AS start, best[2]::BIGINT AS length, best[3]::BIGINT AS period,
        (1000 * best[2] // best[3])::BIGINT AS exponent_milli, sha256(coalesce(r, '')) AS runs_sha256,
        sha256(coalesce(text, '')) AS collapsed_sha256
    FROM changed LEFT JOIN listed USING (doc_id) LEFT JOIN collapsed USING (doc_id)
"""
