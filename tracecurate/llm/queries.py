"""One query per corpus operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chunks, digests, language, lines, near, quality, quotes, search, shards, tiling, topk, trie
from .common import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.find_repeats(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, with_ids=False)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op5_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = quotes.as_mail(table(spark, sf_dir, "conversations"))
    found = quotes.conversations_without_quotes(mail)
    return found.select(F.col("scope").alias("conv_id"), "turn", "role", "text", "parent", "root", "depth", "position", "chat")


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.evaluate_languages(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_runs(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "n_runs", "longest_run", F.sha2("text", 256).alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"), borrow=True)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests.fingerprint_edits(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_bpe": op2_bpe,
    "op3_decontamination": op3_decontamination,
    "op4_topk": op4_topk,
    "op5_quotations": op5_quotations,
    "op6_shards": op6_shards,
    "op7_near_dedup": op7_near_dedup,
    "op8_quality": op8_quality,
    "op9_language": op9_language,
    "op10_line_dedup": op10_line_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_ranked_search": op12_ranked_search,
    "op13_fingerprints": op13_fingerprints,
}

ORACLES: dict[str, str] = {
    "op4_topk": """
        WITH usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        ),
        pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 50 = 0
        ),
        ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id, score
            FROM pairs
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op5_quotations": r"""
        WITH RECURSIVE said AS (
            SELECT conv_id, turn, role, text, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS whole,
                   string_split(text, chr(10)) AS l
            FROM conversations
        ),
        passage AS (
            SELECT conv_id, turn, whole AS key FROM said
            UNION ALL
            SELECT conv_id, turn, trim(regexp_replace(lower(unnest(l)), '\s+', ' ', 'g')) FROM said
        ),
        firsts AS (SELECT conv_id, key, min(turn) AS parent FROM passage GROUP BY ALL),
        links AS (
            SELECT m.conv_id, m.turn, f.parent
            FROM said m
            JOIN said p ON p.conv_id = m.conv_id AND p.turn = m.turn - 1
            JOIN firsts f ON f.conv_id = m.conv_id AND f.key = CASE WHEN m.conv_id % 5 = 1
                THEN trim(regexp_replace(lower(p.l[1]), '\s+', ' ', 'g')) ELSE p.whole END
            WHERE m.conv_id % 5 <> 0
        ),
        climb AS (
            SELECT conv_id, turn, turn AS top, 0 AS depth FROM said
            UNION ALL
            SELECT c.conv_id, c.turn, l.parent, c.depth + 1
            FROM climb c JOIN links l ON l.conv_id = c.conv_id AND l.turn = c.top
        ),
        tops AS (SELECT conv_id, turn, max(depth) AS depth, arg_max(top, depth) AS root FROM climb GROUP BY ALL)
        SELECT s.conv_id, s.turn, s.role, trim(s.text, chr(10) || chr(13)) AS text, l.parent, t.root,
               t.depth, dense_rank() OVER (PARTITION BY s.conv_id, t.root ORDER BY t.depth, s.turn) - 1 AS position,
               s.role || ': ' || trim(s.text, chr(10) || chr(13)) AS chat
        FROM said s JOIN tops t USING (conv_id, turn) LEFT JOIN links l USING (conv_id, turn)
    """,
    "op7_near_dedup": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
            FROM documents
        ),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w
                ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS shingle
            FROM words
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
            FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
            GROUP BY ALL
        ),
        links AS (
            SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
            WHERE 100 * c >= 80 * (p.n + q.n - c)
        ),
        both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION
            SELECT r.doc_id, b.y FROM reach r JOIN both_ways b ON b.x = r.other
        ),
        least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
        SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
        FROM documents d JOIN least l USING (doc_id) LEFT JOIN sizes s USING (doc_id)
    """,
    "op10_line_dedup": r"""
        WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
        numbered AS (
            SELECT doc_id, i - 1 AS line_no, l[i] AS raw, trim(l[i], ' ' || chr(9) || chr(13)) AS line
            FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM split)
        ),
        solid AS (
            SELECT doc_id, line_no, md5(line) AS symbol, len(string_split_regex(line, '[ \t\r\x0B\f]+')) >= 25 AS long,
                   row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS pos
            FROM numbered WHERE line <> ''
        ),
        sizes AS (SELECT doc_id, count(*) AS lines FROM solid GROUP BY doc_id),
        -- Every line with each earlier equal one; equal lines in a row lie on one diagonal.
        pairs AS (
            SELECT a.doc_id, a.pos, b.doc_id AS other, a.pos - b.pos AS diagonal
            FROM solid a JOIN solid b ON a.symbol = b.symbol AND (b.doc_id < a.doc_id OR (b.doc_id = a.doc_id AND b.pos < a.pos))
        ),
        islands AS (
            SELECT *, pos - row_number() OVER (PARTITION BY doc_id, other, diagonal ORDER BY pos) AS island FROM pairs
        ),
        reached AS (
            SELECT doc_id, pos, max(pos) OVER (PARTITION BY doc_id, other, diagonal, island) - pos + 1 AS length FROM islands
        ),
        lengths AS (SELECT doc_id, pos, max(length) AS length FROM reached GROUP BY doc_id, pos),
        marked AS (
            SELECT *, lag(pos) OVER w AS last_pos, lag(length) OVER w AS last_length
            FROM lengths WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
        ),
        runs AS (
            SELECT doc_id, pos, length FROM marked
            WHERE NOT coalesce(last_pos = pos - 1 AND last_length = length + 1, FALSE)
        ),
        going AS (
            SELECT r.doc_id, r.pos, r.length FROM runs r JOIN sizes z USING (doc_id)
            WHERE r.length >= 3 OR (r.pos = 0 AND r.length = z.lines)
               OR EXISTS (FROM solid s WHERE s.long AND s.doc_id = r.doc_id AND s.pos BETWEEN r.pos AND r.pos + r.length - 1)
        ),
        gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + length)) AS pos FROM going),
        edges AS (
            SELECT doc_id, pos, coalesce(lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) <> pos - 1, TRUE) AS starts FROM gone
        ),
        counts AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (starts) AS n_runs FROM edges GROUP BY doc_id),
        dropped AS (SELECT s.doc_id, s.line_no FROM solid s JOIN gone g USING (doc_id, pos)),
        texts AS (
            SELECT n.doc_id, string_agg(n.raw, chr(10) ORDER BY n.line_no) FILTER (d.line_no IS NULL) AS kept
            FROM numbered n LEFT JOIN dropped d USING (doc_id, line_no) GROUP BY n.doc_id
        ),
        longest AS (SELECT doc_id, max(length) AS longest_run FROM runs GROUP BY doc_id)
        SELECT d.doc_id, CAST(coalesce(z.lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(c.n_removed, 0) AS INTEGER) AS n_removed,
               CAST(coalesce(c.n_runs, 0) AS INTEGER) AS n_runs, CAST(coalesce(g.longest_run, 0) AS INTEGER) AS longest_run,
               CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(t.kept, '')) END AS kept_sha256
        FROM documents d LEFT JOIN sizes z USING (doc_id) LEFT JOIN counts c USING (doc_id) LEFT JOIN texts t USING (doc_id)
        LEFT JOIN longest g USING (doc_id)
    """,
    "op11_prefix_trie": """
        WITH said AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(md5(coalesce(role, '')) || coalesce(text, ''))) - 1 AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        -- CRC-32 of the decimal digits, bit by bit.
        convs AS (
            SELECT conv_id, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''),
                lambda d: ascii(d)::BIGINT)), lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)),
                lambda x, k: xor(x >> 1, 3988292384 * (x & 1))))) % 9 AS h
            FROM (SELECT DISTINCT conv_id FROM said)
        ),
        rebuilt AS (
            SELECT c.conv_id, s.pos, s.role, s.text FROM convs c JOIN said s ON s.conv_id = c.conv_id - c.conv_id % 5 AND s.pos < c.h
            UNION ALL
            SELECT c.conv_id, s.pos, s.role, s.text FROM convs c JOIN said s ON s.conv_id = c.conv_id AND s.pos >= c.h
        ),
        placed AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth, md5(role) || md5(text) AS symbol,
                   strlen(text) AS size
            FROM rebuilt
        ),
        prefixes AS (
            SELECT conv_id, depth, size, md5(string_agg(symbol, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM placed
            UNION ALL
            SELECT conv_id, 0, 0, '' FROM convs
        ),
        lasts AS (SELECT conv_id, arg_max(node, depth) AS node FROM prefixes GROUP BY conv_id),
        ends AS (SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM lasts GROUP BY node),
        nodes AS (
            SELECT node, depth, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n_convs FROM prefixes GROUP BY node, depth
        ),
        edges AS (
            SELECT n.node, p.node AS parent FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
        ),
        kids AS (SELECT parent AS node, count(*) AS n_children FROM edges GROUP BY parent),
        below AS (
            SELECT p.node, sum((n.n_convs - 1) * n.size) AS saved_tokens, count(*) FILTER (k.node IS NULL) AS n_leaves
            FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN kids k ON k.node = n.node
            GROUP BY p.node
        )
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, b.n_leaves,
               CAST(b.saved_tokens AS BIGINT) AS saved_tokens, coalesce(x.ends_sha256, sha256('')) AS ends_sha256
        FROM nodes n JOIN below b ON b.node = n.node LEFT JOIN kids k ON k.node = n.node LEFT JOIN ends x ON x.node = n.node
        LEFT JOIN edges e ON e.node = n.node LEFT JOIN nodes p ON p.node = e.parent
    """,
    "op12_ranked_search": r"""
        WITH words AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents
        ),
        docs AS (SELECT r, doc_id, w, len(w) AS n FROM words WHERE len(w) > 0),
        stats AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM docs),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ),
        counts AS (
            SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs)
            WHERE term IN (SELECT term FROM asked) GROUP BY r, term
        ),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * CAST(s.docs AS DOUBLE) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
            FROM counts, stats s GROUP BY term, s.docs
        ),
        scores AS (
            SELECT a.item_id, c.r, d.doc_id,
                   CAST(sum(w.weight * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (100 - 90 + (90 * d.n * s.docs) // s.length)))) AS BIGINT) AS score
            FROM asked a JOIN counts c USING (term) JOIN weights w USING (term) JOIN docs d ON d.r = c.r, stats s
            GROUP BY a.item_id, c.r, d.doc_id
        ),
        ranked AS (
            SELECT item_id, doc_id, score,
                   CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
            FROM scores WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
}
