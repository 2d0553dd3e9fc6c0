"""Registered queries of the numbered operators, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tranche.llm import (
    alignment, chat, decontaminate, jaccard, lines, mixing, personal, quality, sharding, tokens, toxicity, trie,
    vectors,
)
from tranche.llm.frames import importable
from tranche.llm.labelled import fold
from tranche.session import run_folder

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}
SQL: dict[str, str] = {}


def registered(query: Query) -> Query:
    REGISTERED[query.__name__] = query
    return query


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{folder}/{name}.parquet")


@registered
def op2_shard(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"))


@registered
def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    judged, names = decontaminate.contamination(documents, table(spark, folder, "benchmark"))
    return judged.select("doc_id", *names)


SQL["op10_decontaminate"] = r"""
WITH tokens AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), patterns AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS m,
        array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS pattern
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)
), lengths AS (
    SELECT DISTINCT m FROM patterns
), windows AS (
    SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS pattern
    FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM tokens CROSS JOIN lengths)
), found AS (
    SELECT doc_id, i, m, item_id FROM windows JOIN patterns USING (m, pattern)
), hits AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + m)) AS word FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM tokens LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def tokenizer_definition(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def piece_model(name: str = "piece_bpe_32k.model") -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


@registered
def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = f"{run_folder(spark)}/tokens"
    tokens.write(table(spark, folder, "documents"), tokenizer_definition(), target)
    return tokens.read(spark, target)


@registered
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels")
    lexicon = toxicity.learn(documents, labels, fold(F.col("doc_id"), 5) != 0)
    rows, score = toxicity.scored(documents, lexicon)
    return rows.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        F.col(score).alias("score"),
        (F.col(score) >= 0.5).cast("int").alias("predicted"),
    )


@registered
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels")
    ensemble = quality.learn(documents, labels, fold(F.col("doc_id"), 4) != 2)
    rows, score = quality.scored(documents, ensemble)
    return rows.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        F.col(score).alias("score"),
        (F.col(score) >= 0.7).cast("int").alias("predicted"),
    )


@registered
def op7_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


SQL["op7_near_vectors"] = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
    SELECT vec_id, vec_id AS other FROM embeddings
    UNION
    SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.other = links.a
), component AS (
    SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
), degree AS (
    SELECT a, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM component LEFT JOIN degree ON vec_id = a
"""


@registered
def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.linked_documents(table(spark, folder, "documents"))


SQL["op6_jaccard_join"] = r"""
WITH RECURSIVE tokens AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM tokens WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a, b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
        FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
    ) JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * common >= 75 * (p.n + q.n - common)
), reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""


@registered
def op1_mix(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return mixing.mix(documents, mixing.tempered(documents))[0]


SQL["op1_mix"] = """
WITH RECURSIVE sources AS (
    SELECT source, sum(strlen(coalesce(text, '')) + 1) AS size FROM documents GROUP BY source
), weights AS (
    SELECT source, CAST(size AS DOUBLE) AS size, floor(sqrt(CAST(size AS DOUBLE))) AS weight FROM sources
), rates AS (
    SELECT source, (weight / sum(weight) OVER ()) * (sum(size) OVER () / size) AS rate FROM weights
), parts AS (
    SELECT source, greatest(ceil(rate / 16.0), 1) AS parts, rate / greatest(ceil(rate / 16.0), 1) AS rate FROM rates
), steps AS (
    SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM parts
    UNION ALL
    SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM steps WHERE k < 80
), draws AS (
    SELECT doc_id, source, CAST(CAST('0x' || md5('count:42:' || doc_id || ':' || i)[1:13] AS BIGINT) AS DOUBLE)
        / 4503599627370496.0 AS u
    FROM (SELECT doc_id, source, unnest(range(1, CAST(parts AS BIGINT) + 1)) AS i FROM documents JOIN parts USING (source))
), counts AS (
    SELECT doc_id, count(*) AS n FROM draws JOIN steps ON draws.source = steps.source AND u >= c GROUP BY doc_id
), copies AS (
    SELECT documents.*, unnest(range(1, n + 1)) AS copy FROM documents JOIN counts USING (doc_id)
)
SELECT doc_id, text, lang, source, n_chars, copy,
    row_number() OVER (ORDER BY md5('order:42:' || doc_id || ':' || copy), doc_id, copy) - 1 AS position
FROM copies
"""


@registered
def op3_chat(spark: SparkSession, folder: str) -> DataFrame:
    spans = F.transform("mask", lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string")))
    return chat.rotated(table(spark, folder, "conversations")).withColumn("mask", F.array_join(spans, ","))


SQL["op3_chat"] = r"""
WITH turns AS (
    SELECT conv_id, role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text) - 1 AS place
    FROM conversations
), people AS (
    SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role <> 'system'
), seen AS (
    SELECT conv_id, perspective, place, place // 512 AS chunk, role IS NOT DISTINCT FROM perspective AS own,
        '<|im_start|>' || replace(CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN 'system'
            ELSE 'user' || coalesce(' name=' || role, '') END, '<|', '< |') || chr(10) AS head,
        replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS body
    FROM turns JOIN people USING (conv_id)
), spans AS (
    SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective, chunk ORDER BY place) AS stop
    FROM seen
)
SELECT conv_id, perspective, chunk, count(*) AS turns, string_agg(head || body, '' ORDER BY place) AS text,
    coalesce(string_agg((stop - length(body)) || '-' || stop, ',' ORDER BY place) FILTER (own), '') AS mask
FROM spans GROUP BY conv_id, perspective, chunk
"""


@registered
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return lines.deduplicated(documents)[0]


@registered
def op11_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal.personal_spans(table(spark, folder, "documents"))
    kinds = F.col("base.kind")
    counts = [
        (F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}")
        for k, name in enumerate(personal.KINDS)
    ]
    base = F.sha2(personal.listed(F.col("base")).cast("binary"), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), personal.listed(F.col("spans")).alias("spans"))


@registered
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    found = trie.prefix_trie(trie.grafted(trie.ordered(table(spark, folder, "conversations"))))
    nodes = found.nodes.join(trie.digests_of_ends(found.ends), "id", "left")
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )


SQL["op12_prefix_trie"] = r"""
WITH turns AS (
    SELECT conv_id AS c, role, text, row_number() OVER (PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) - 1 AS place
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL)
), members AS (
    SELECT c, c - c % 5 AS base, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(1, length(c::VARCHAR) + 1),
            lambda i: unicode(substr(c::VARCHAR, i::INT, 1))::BIGINT)),
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
            lambda x, step: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) % 9 AS h
    FROM (SELECT DISTINCT c FROM turns)
), rebuilt AS (
    SELECT m.c, 0 AS part, t.place, t.role, t.text FROM members m JOIN turns t ON t.c = m.base AND t.place < m.h
    UNION ALL
    SELECT m.c, 1, t.place, t.role, t.text FROM members m JOIN turns t ON t.c = m.c AND t.place >= m.h
), numbered AS (
    SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY part, place) AS depth,
        count(*) OVER (PARTITION BY c) AS length
    FROM rebuilt
), steps AS (
    SELECT c, depth, length, strlen(text) AS size, list(sha256(strlen(role) || ':' || role || text))
        OVER (PARTITION BY c ORDER BY depth) AS key
    FROM numbered
    UNION ALL
    SELECT m.c, 0, coalesce(max(n.depth), 0), 0, []
    FROM members m LEFT JOIN numbered n ON n.c = m.c GROUP BY m.c
), nodes AS (
    SELECT key, depth, count(*) AS n_convs, min(c) AS c, min(size) AS size,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (depth = length), '')) AS ends_sha256
    FROM steps GROUP BY key, depth
), children AS (
    SELECT key[1:depth - 1] AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), valued AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * size AS saved
    FROM nodes LEFT JOIN children USING (key)
), totals AS (
    SELECT s.key, sum((v.n_children = 0)::BIGINT) AS n_leaves, sum(v.saved) AS saved_tokens
    FROM valued v JOIN steps s ON s.c = v.c AND s.depth <= v.depth GROUP BY s.key
)
SELECT v.c AS conv_id, v.depth::BIGINT AS depth, p.c AS parent_conv_id, v.n_convs, v.n_children,
    t.n_leaves::BIGINT AS n_leaves, t.saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
FROM valued v JOIN totals t USING (key)
LEFT JOIN nodes p ON v.depth > 0 AND p.depth = v.depth - 1 AND p.key = v.key[1:v.depth - 1]
"""


@registered
def op13_align_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"), tokenizer_definition(), piece_model())
