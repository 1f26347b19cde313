"""Registered queries of this package and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpulse.llm import (
    conversation_trie,
    embedding_dedup,
    exact_dedup,
    language_model,
    line_dedup,
    packing,
    pieces,
    quality,
    simhash_dedup,
    spelling,
    substring_dedup,
    suffix_dedup,
    url_filters,
)
from shelfpulse.llm.common import Scratch, one_space

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"), Scratch(spark))


ORACLE_SQL["op10_exact_dedup"] = r"""
WITH digests AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       text_sha256
FROM digests
WINDOW same AS (PARTITION BY text_sha256)
"""


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = substring_dedup.remove_repeats(docs, Scratch(spark))
    kept = F.regexp_replace(one_space(F.col("text")), "^ | $", "")
    return done.select(
        "doc_id",
        F.col("n_units").alias("n_words"),
        "n_removed",
        F.sha2(kept, 256).alias("kept_sha256"),
    )


ORACLE_SQL["op3_substring_dedup"] = r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), words AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i,
           unnest(list_transform(range(len(words)), lambda p: CASE WHEN p + 50 <= len(words)
               THEN md5(array_to_string(words[p + 1 : p + 50], ' ')) END)) AS name
    FROM texts
), owned AS (
    SELECT *, name IS NOT NULL AND doc_id > min(doc_id) OVER (PARTITION BY name) AS repeats FROM words
), marked AS (
    SELECT *, bool_or(repeats) OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
    FROM owned
), kept AS (
    SELECT doc_id, count(*) AS n_words, count_if(gone) AS n_removed,
           string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS text
    FROM marked GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = suffix_dedup.remove_repeats(docs, Scratch(spark))
    return done.select(
        "doc_id",
        F.col("n_units").alias("n_bytes"),
        "n_removed",
        "n_spans",
        F.sha2("text", 256).alias("kept_sha256"),
    )


ORACLE_SQL["op4_suffix_dedup"] = r"""
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
), bytes AS (
    SELECT doc_id, digits, unnest(range(length(digits) // 2)) AS i FROM texts
), named AS (
    SELECT doc_id, i, substr(digits, 2 * i + 1, 2) AS byte,
           CASE WHEN 2 * i + 100 <= length(digits) THEN md5(substr(digits, 2 * i + 1, 100)) END AS name
    FROM bytes
), owned AS (
    SELECT *, name IS NOT NULL AND doc_id > min(doc_id) OVER (PARTITION BY name) AS repeats FROM named
), marked AS (
    SELECT *, bool_or(repeats) OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
    FROM owned
), edges AS (
    SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins
    FROM marked
), kept AS (
    SELECT doc_id, count(*) AS n_bytes, count_if(gone) AS n_removed, count_if(begins) AS n_spans,
           string_agg(byte, '' ORDER BY i) FILTER (NOT gone) AS digits
    FROM edges GROUP BY doc_id
)
SELECT doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept.digits, ''))) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""


@query
def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_dedup.near_duplicates(docs, Scratch(spark)).select(
        "doc_id",
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        "component_id",
    )


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


@query
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_held_out(table(spark, sf_dir, "documents"), Scratch(spark))


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    return quality.classify(docs.select("doc_id", "text"), labels, Scratch(spark))


@query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), Scratch(spark))


@query
def op5_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), with_ids=False)


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = line_dedup.drop_recurring(docs, Scratch(spark))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages").select("page_id", "url"), Scratch(spark))


#: crc32 of a list of byte values.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, {}), lambda c, b: list_reduce(
    list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(table(spark, sf_dir, "conversations"), Scratch(spark))


ORACLE_SQL["op11_conversation_trie"] = (
    r"""
WITH original AS (
    SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                         ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns,
           """
    + CRC32.format("list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)")
    + r""" % 4 AS h
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1 : c.h], c.turns[c.h + 1 :]) AS turns
    FROM original c LEFT JOIN original b ON b.conv_id = c.conv_id - c.conv_id % 20
), members AS (
    SELECT conv_id, d.d AS depth, turns[1 : d.d] AS path, d.d = len(turns) AS ends
    FROM rebuilt, LATERAL (SELECT unnest(range(len(turns) + 1)) AS d) d
), nodes AS (
    SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(len(regexp_extract_all(path[depth].t, '[^ 	-]+')), 0) AS words,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM members GROUP BY depth, path
), children AS (
    SELECT path[1 : depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), counted AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)
), totals AS (
    SELECT path[1 : d.d] AS path, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
    FROM counted, LATERAL (SELECT unnest(range(depth + 1)) AS d) d GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, t.n_leaves::BIGINT AS n_leaves,
       t.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM counted n JOIN totals t USING (path)
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.path[1 : n.depth - 1]
"""
)


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark))


ORACLE_SQL["op13_spelling_variants"] = (
    r"""
WITH RECURSIVE runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') || ':' AS doc,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents
), counted AS (
    SELECT run, hex(encode(doc || run)) AS digits, count(*) AS n FROM runs GROUP BY ALL
), hashed AS (
    SELECT run, n, """
    + CRC32.format(
        "list_transform(range(len(digits) // 2), lambda i: ('0x' || substr(digits, (2 * i + 1)::BIGINT, 2))::BIGINT)"
    )
    + r""" AS h
    FROM counted
), words AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
           sum(n)::BIGINT AS n
    FROM hashed GROUP BY 1
), vocabulary AS (
    SELECT word, n FROM words WHERE length(word) >= 5 AND n >= 3
), gaps AS (
    SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
    FROM vocabulary, LATERAL (SELECT unnest(range(length(word))) AS i)
), pairs AS (
    SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b USING (i, rest) WHERE a.word <> b.word
    UNION SELECT g.word, g.n, v.word, v.n FROM gaps g JOIN vocabulary v ON v.word = g.rest
    UNION SELECT v.word, v.n, g.word, g.n FROM gaps g JOIN vocabulary v ON v.word = g.rest
), best AS (
    SELECT word, count(*) AS n_near, (list(near ORDER BY near_n DESC, near))[1] AS near, max(near_n) AS near_n
    FROM pairs GROUP BY word
), forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form,
           CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
    FROM vocabulary LEFT JOIN best USING (word)
), chains AS (
    SELECT word, word AS root FROM forms WHERE form IS NULL
    UNION ALL SELECT f.word, c.root FROM forms f JOIN chains c ON f.form = c.word
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN chains USING (word)
"""
)
