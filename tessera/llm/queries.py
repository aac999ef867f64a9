"""Registered queries of the document operators: whole tables, production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (chat, exact_dedup, filter_audit, mixing, packing, quality, records, retrieval_packing, secrets, simhash,
                         sketches, toxicity, whitening)
from tessera.llm.common import written
from tessera.session import scratch_path, table


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def learnable(labels: DataFrame, label: str, n: int, held: int) -> DataFrame:
    return labels.filter(remainder(F.col("doc_id"), n) != held).select("doc_id", F.col(label).alias("label"))


def _scored(docs: DataFrame, score: Column, n: int, held: int, cut: float, more: list[str] | None = None) -> DataFrame:
    return docs.select("doc_id", (remainder(F.col("doc_id"), n) == held).alias("held_out"), score.alias("score"), *more or []).withColumn(
        "predicted", (F.col("score") >= cut).cast("int"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, learnable(table(spark, sf_dir, "labels"), "quality", 4, 2))
    return _scored(docs, quality.score_column(spark, model, docs["text"]), 4, 2, 0.7)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = sketches.neighbours(table(spark, sf_dir, "documents"))
    return near.select(
        "doc_id", "n_chars", "edited_sha256", sketches.as_text(F.col("sketch")).alias("fingerprint"),
        sketches.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        sketches.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        sketches.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


def op3_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.encode_to_records(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(secrets.spans_text("base_spans"), 256).alias("base_sha256"),
                        secrets.spans_text("all_spans").alias("spans"), "n_owned", "n_live", "n_example")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], turns.schema)
    out = written(chat.examples(turns.unionByName(extra)), "chat-examples")
    return chat.read_back(out).select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, learnable(table(spark, sf_dir, "labels"), "toxic", 5, 0))
    told = docs.select("doc_id", toxicity.evidence_column(spark, model, docs["text"]).alias("e")).select("doc_id", "e.*")
    return _scored(told, F.col("score"), 5, 0, 0.5, ["neighbours", "labels", "cosines"])


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op11_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_quality, op2_fingerprints, op3_records, op4_secrets, op5_packing,
                                   op6_exact_dedup, op7_chat, op8_mixing, op9_toxicity, op10_simhash,
                                   op11_retrieval_packing, op12_whitening, op13_filter_audit)}

ORACLES = {
    "op6_exact_dedup": """
        WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
                   FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM n""",
    "op7_chat": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
            UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
        n AS (SELECT *, row_number() OVER w AS no, count(*) OVER (PARTITION BY conv_id) AS n,
                     sum(length(role) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 24) OVER w AS upto
              FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY no)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY no) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(CASE WHEN role = 'assistant' OR no = n THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars
        FROM n GROUP BY conv_id""",
    "op8_mixing": r"""
        WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
        p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
              FROM s GROUP BY source),
        w AS (SELECT *, CASE place % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS weight FROM p),
        c AS (SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight,
                     coalesce(sum(3 * source_size) OVER b, 0) AS full_before, coalesce(sum(weight) OVER b, 0) AS weight_before
              FROM w WINDOW b AS (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        f AS (SELECT *, 3 * source_size * (all_weight - weight_before) <= weight * (total - full_before) AS is_full FROM c),
        l AS (SELECT *, CAST(total - sum(CASE WHEN is_full THEN 3 * source_size ELSE 0 END) OVER () AS BIGINT) AS words,
                     CAST(all_weight - sum(CASE WHEN is_full THEN weight ELSE 0 END) OVER () AS BIGINT) AS open_weight FROM f),
        t AS (SELECT source, source_size, CASE WHEN is_full THEN CAST(3 * source_size AS DOUBLE)
                     ELSE CAST(weight * words AS DOUBLE) / CAST(open_weight AS DOUBLE) END AS target FROM l),
        r AS (SELECT *, CASE WHEN source_size > 0 THEN least(3.0::DOUBLE, target / source_size) ELSE 1.0::DOUBLE END AS rate FROM t),
        d AS (SELECT s.doc_id, s.size, r.source_size, r.target, r.rate,
                     ('0x' || substr(md5('42:' || coalesce(CAST(s.doc_id AS VARCHAR), 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
              FROM s JOIN r ON s.source IS NOT DISTINCT FROM r.source)
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
               CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM d""",
    "op13_filter_audit": r"""
        WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        d AS (SELECT part, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
                     100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c,
                     regexp_matches(t, '[#$%&*|]') AS d,
                     coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, doc_id IS NULL AND min(doc_id) OVER (PARTITION BY t) IS NOT NULL) AS e,
                     coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic
              FROM w LEFT JOIN (SELECT doc_id AS id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY 1) l ON doc_id = id),
        m AS (SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
                                  CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS fails,
                     count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM d GROUP BY 1, 2),
        l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        o AS (SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM l a, l b, l c, l d, l e
              WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        s AS (SELECT part, filter_order, step, fails, n, good, toxic, contains(fails, substr(filter_order, step, 1)) AS own,
                     step > 1 AND fails <> translate(fails, substr(filter_order, 1, step - 1), '') AS gone
              FROM m, o, (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS step)),
        r AS (SELECT part, filter_order, step, CAST(sum(CASE WHEN NOT gone AND NOT own THEN n ELSE 0 END) AS BIGINT) AS kept,
                     CAST(sum(CASE WHEN NOT gone AND own THEN n ELSE 0 END) AS BIGINT) AS removed,
                     CAST(sum(CASE WHEN gone AND own THEN n ELSE 0 END) AS BIGINT) AS redundant,
                     CAST(sum(CASE WHEN fails = substr(filter_order, step, 1) THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
                     CAST(sum(CASE WHEN NOT gone AND own THEN good ELSE 0 END) AS BIGINT) AS good_lost,
                     CAST(sum(CASE WHEN NOT gone AND own THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
              FROM s GROUP BY ALL)
        SELECT *, CAST(sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)) AS BIGINT) AS shapley FROM r""",
}
