"""The operators as queries over their whole tables: (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm.exact_dedup import LOWER, UPPER, exact_dedup
from tenura.llm.line_chunks import passage_dedup
from tenura.llm.near_join import near_join
from tenura.llm import toxicity
from tenura.llm import language_id
from tenura.llm.merge_dropout import decode, encode
from tenura.llm.neighbours import nearest
from tenura.llm.packing import pack
from tenura.llm.page_text import extract
from tenura.llm.prefix_trie import prefix_trie
from tenura.llm.secret_scan import scan
from tenura.llm.token_files import digest, read_tokens, write_tokens
from tenura.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, places = pack(table(spark, sf_dir, "documents"))
    return places.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join(table(spark, sf_dir, "documents")).drop("text_mark")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(read_tokens(write_tokens(table(spark, sf_dir, "documents"))))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).drop("text_mark")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "removed_chunks", "removed_lines")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("text_mark")


def op8_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = decode(encode(table(spark, sf_dir, "documents")))
    return both.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"),
                       F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.col("text")).alias("lossless"))


def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(language_id.learned_rows(docs)))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_token_files": op4_token_files,
    "op5_toxicity": op5_toxicity,
    "op6_line_dedup": op6_line_dedup,
    "op7_secret_scan": op7_secret_scan,
    "op8_merge_dropout": op8_merge_dropout,
    "op9_page_text": op9_page_text,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_language_id": op11_language_id,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": f"""
        WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS body FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
        FROM lowered WINDOW same AS (PARTITION BY body)""",
    # all pairs that share a 5-gram, and everything reachable by links
    "op3_ngram_jaccard_join": """
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+') AS words FROM documents),
        grams AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [''] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS gram FROM split),
        sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM grams a JOIN grams b USING (gram)
            WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
        links AS (
            SELECT x, y, shared.n = one.n AND shared.n = two.n AS same FROM shared JOIN sizes one ON one.doc_id = x
            JOIN sizes two ON two.doc_id = y WHERE shared.n >= 0.8 * (one.n + two.n - shared.n) - 1e-9),
        reached(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT reached.doc_id, y FROM reached JOIN links ON x = other),
        classes AS (SELECT doc_id, min(other) AS class_id FROM reached GROUP BY doc_id),
        degrees AS (SELECT x AS doc_id, count(*) AS n_links, count(*) FILTER (WHERE same) AS copies FROM links GROUP BY x)
        SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, coalesce(copies, 0) + 1 AS class_size, doc_id = class_id AS kept
        FROM classes LEFT JOIN degrees USING (doc_id)""",
    # every prefix as the digests of its turns one behind the other; a subtree is what starts with a node's
    "op13_conversation_trie": """
        WITH turns AS (
            SELECT conv_id, turn, length(coalesce(text, '')) AS points, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark
            FROM conversations WHERE conv_id IS NOT NULL),
        placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) AS place FROM turns),
        sizes AS (SELECT conv_id, count(*) AS n FROM placed GROUP BY conv_id),
        hashed AS (
            SELECT conv_id, conv_id - conv_id % 100 AS base,
                   (xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                       lambda digit: list_prepend(ascii(digit)::BIGINT, [-1, -1, -1, -1, -1, -1, -1, -1])))),
                       lambda c, x: CASE WHEN x < 0 THEN xor(c >> 1, (c & 1) * 3988292384) ELSE xor(c, x) END), 4294967295)) % 6 AS h
            FROM sizes),
        convs AS (SELECT hashed.*, least(h, coalesce(n, 0)) AS shared FROM hashed LEFT JOIN sizes ON sizes.conv_id = hashed.base),
        rebuilt AS (
            SELECT convs.conv_id, place AS depth, points, mark FROM convs JOIN placed ON placed.conv_id = convs.base WHERE place <= shared
            UNION ALL
            SELECT convs.conv_id, place - h + shared, points, mark FROM convs JOIN placed ON placed.conv_id = convs.conv_id WHERE place > h),
        prefixes AS (
            SELECT conv_id, depth, points, string_agg(mark, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM rebuilt
            UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
        nodes AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(points) AS points FROM prefixes GROUP BY depth, path),
        children AS (SELECT depth - 1 AS depth, left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2),
        whole AS (SELECT conv_id, max(depth) AS depth FROM prefixes GROUP BY conv_id),
        ends AS (
            SELECT depth, path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM prefixes JOIN whole USING (conv_id, depth) GROUP BY depth, path),
        below AS (
            SELECT above.depth, above.path, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((under.n_convs - 1) * under.points) AS saved_tokens
            FROM nodes above JOIN nodes under ON under.depth >= above.depth AND left(under.path, 32 * above.depth) = above.path
            LEFT JOIN children ON children.depth = under.depth AND children.path = under.path GROUP BY above.depth, above.path)
        SELECT nodes.conv_id, nodes.depth, parents.conv_id AS parent_conv_id, nodes.n_convs, coalesce(n_children, 0) AS n_children,
               n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
        FROM nodes JOIN below USING (depth, path) LEFT JOIN children USING (depth, path) LEFT JOIN ends USING (depth, path)
        LEFT JOIN nodes parents ON parents.depth = nodes.depth - 1 AND parents.path = left(nodes.path, 32 * (nodes.depth - 1))""",
}
