"""One query per corpus operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedsieve.llm import (
    bpe_codec,
    chat_format,
    collocations,
    exact_dedup,
    language_id,
    ngram_join,
    packing,
    sharding,
    suffix_dedup,
    token_alignment,
    token_counts,
    topk,
    toxicity,
)

SEQUENCE = 1024
TOXIC_FROM = 0.3
N_SHARDS = 16
# Arrow batches are bounded by rows alone; texts are long.
BATCH_ROWS = "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > SEQUENCE)


def op2_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat_format.turns_of(table(spark, sf_dir, "conversations"))
    return chat_format.preference_segments(turns, chat_format.pairs_by_opening(turns))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.where("id % 100 = 0"), vectors)


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe_codec.encode_documents(table(spark, sf_dir, "documents"), ranks)
    return bpe_codec.decode_ids(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_texts(docs, model).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.shuffle_shards(table(spark, sf_dir, "documents"), N_SHARDS)
    return shards.select(
        "doc_id",
        sharding.record_size().alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE
    )


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_components(table(spark, sf_dir, "documents"), nameless=True)


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.fit(docs))
    return found.select(
        "doc_id",
        language_id.held_out().alias("held_out"),
        F.col("nearest").alias("lang_pred"),
        "score",
        "rejected",
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.aligned_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_token_counts,
        op2_preferences,
        op3_suffix_dedup,
        op4_exact_dedup,
        op5_top_k,
        op6_bpe_codec,
        op7_toxicity,
        op8_shards,
        op9_packing,
        op10_ngram_join,
        op11_language_id,
        op12_collocations,
        op13_token_alignment,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    normal = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"
    return {
        "op2_preferences": """
            WITH turns AS (
                SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, '') AS role,
                       coalesce(text, '') AS text
                FROM conversations WHERE conv_id IS NOT NULL),
            opening AS (
                SELECT conv_id, turn, role, text FROM turns
                QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) = 1),
            pairs AS (
                SELECT conv_id AS rejected_id,
                       CASE WHEN count(*) OVER same = 1 AND conv_id % 2 = 1 THEN conv_id - 1
                            ELSE min(conv_id) OVER same END AS chosen_id
                FROM opening WINDOW same AS (PARTITION BY turn, role, text)),
            lines AS (
                SELECT p.*, t.turn, t.role, t.text, t.conv_id = p.chosen_id AS chosen
                FROM pairs p JOIN turns t ON t.conv_id IN (p.chosen_id, p.rejected_id)
                WHERE p.chosen_id <> p.rejected_id
                  AND p.chosen_id IN (SELECT conv_id FROM turns)),
            parted AS (
                SELECT rejected_id, min(turn) AS at FROM (
                    SELECT rejected_id, turn FROM lines
                    GROUP BY rejected_id, turn, role, text HAVING count(*) < 2)
                GROUP BY rejected_id),
            parts AS (
                SELECT l.*, CASE WHEN p.at IS NULL OR l.turn < p.at THEN 'prompt'
                                 WHEN l.chosen THEN 'chosen' ELSE 'rejected' END AS part
                FROM lines l LEFT JOIN parted p USING (rejected_id))
            SELECT DISTINCT rejected_id AS pair_id, chosen_id, rejected_id, part, turn, role,
                   '<|' || role || '|>' || chr(10) || text || chr(10) AS rendered,
                   role = 'assistant' AND part <> 'prompt' AS loss
            FROM parts""",
        "op4_exact_dedup": f"""
            SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                   doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
            FROM (SELECT doc_id, {normal} AS body FROM documents)
            WINDOW same AS (PARTITION BY body)""",
        "op12_collocations": r"""
            WITH pieces AS (
                SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(
                    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
            lines AS (
                SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws
                FROM pieces),
            sizes AS (SELECT lang, CAST(sum(len(ws)) AS HUGEINT) AS n FROM lines GROUP BY lang),
            phrases AS MATERIALIZED (
                SELECT lang, list_slice(ws, i, i + k - 1) AS p, k, CAST(count(*) AS HUGEINT) AS f
                FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
                      FROM lines, (SELECT unnest(range(1, 6)) AS k))
                GROUP BY ALL HAVING count(*) >= 100),
            several AS (SELECT * FROM phrases WHERE k > 1),
            held AS (
                SELECT lang, p, max(f) AS longer
                FROM (SELECT lang, f, list_slice(p, i, i + m - 1) AS p
                      FROM (SELECT *, unnest(range(1, k - m + 2)) AS i
                            FROM (SELECT *, unnest(range(2, k)) AS m FROM several)))
                GROUP BY lang, p),
            cuts AS (
                SELECT s.*, unnest(range(1, k)) AS cut FROM several s LEFT JOIN held h USING (lang, p)
                WHERE h.longer IS NULL OR 100 * h.longer < 100 * s.f),
            scored AS (
                SELECT c.lang, c.p, c.k, c.f AS a, x.f AS l, y.f AS r, n, cut,
                       (1000 * c.f * n) // (x.f * y.f) AS score
                FROM cuts c JOIN sizes USING (lang)
                JOIN phrases x ON x.lang = c.lang AND x.p = list_slice(c.p, 1, cut)
                JOIN phrases y ON y.lang = c.lang AND y.p = list_slice(c.p, cut + 1, c.k)),
            weakest AS (
                SELECT *, array_to_string(p, ' ') AS phrase FROM scored
                QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1)
            SELECT lang, row_number() OVER best AS rank, phrase, CAST(a AS BIGINT) AS a,
                   CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
                   CAST(score AS BIGINT) AS score, CAST(k AS INTEGER) AS k
            FROM weakest
            WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
            QUALIFY row_number() OVER best <= 2000""",
    }
