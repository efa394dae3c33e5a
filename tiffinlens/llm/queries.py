"""The queries of the training-data operators over the given tables, each a function of (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, htmltext, lines, merkle, quality, rules, secrets, simhash, tiling, tokenfiles, toolchat, warc

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
WORD_FILE = "word_bpe_49k.json"
BYTE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"
END_ID = 2

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.drop_boilerplate(documents, counts=True)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    network = quality.train(documents, _table(spark, sf_dir, "labels"))
    return quality.with_quality(documents, network).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.apply_rules(documents).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as the first versions a ledger sees."""
    versions = _table(spark, sf_dir, "documents").select("doc_id", "text")
    _, findings = secrets.scan_increment(versions, path="doc_id")
    found = secrets.findings_by_path(versions, findings, path="doc_id")
    return found.select(
        "doc_id",
        *[secrets.count_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.joined_spans(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
        secrets.joined_spans(F.col("spans")).alias("spans"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.with_components(documents).select(
        "doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error"
    )


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extracted(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(
        _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark")
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encoded(
        documents,
        public_tokenizers.path(RANK_FILE),
        public_tokenizers.PATTERN,
        ["doc_id"],
        ("ids_sha256", "decoded_sha256"),
    )


LOOKUP = {
    "type": "object",
    "properties": {
        "words": {"type": "integer", "minimum": 1, "maximum": 40},
        "question": {"type": "string", "minLength": 1},
    },
    "required": ["question", "words"],
    "additionalProperties": False,
}


def tool_messages(conversations: DataFrame, chained: bool = False) -> DataFrame:
    """The conversations with tool use in them: each user's turn calls ``lookup``, the turn after it is the result.

    Both are logged in the order in which a busy log might have them: the call
    of an odd turn a turn late, together with its result. If ``chained``, each
    call waits for the result of the call two turns before, and every second
    one is logged three turns early, ahead of what it waits for.
    """
    turn, asked = F.col("turn"), F.col("role") == "user"
    after, logged = F.array().cast("array<string>"), turn + turn % 2
    if chained:
        after = F.when(turn >= 2, F.array(F.concat(F.lit("call-"), (turn - 2).cast("string")))).otherwise(after)
        logged = F.when(turn % 4 >= 2, F.greatest(turn - 3, F.lit(0).cast("long"))).otherwise(logged)
    call = F.struct(
        F.concat(F.lit("call-"), turn.cast("string")).alias("id"),
        F.lit("lookup").alias("name"),
        F.to_json(
            F.struct(F.col("text").alias("question"), F.size(F.split("text", " ")).alias("words"))
        ).alias("arguments"),
        after.alias("after"),
    )
    none = F.array().cast("array<struct<id:string,name:string,arguments:string,after:array<string>>>")
    nothing = F.lit(None).cast("string")
    plain = conversations.select("conv_id", "turn", "role", "text", none.alias("tool_calls"), nothing.alias("tool_call_id"))
    calls = conversations.where(asked).select(
        "conv_id",
        logged.alias("turn"),
        F.lit("assistant").alias("role"),
        nothing.alias("text"),
        F.array(call).alias("tool_calls"),
        nothing.alias("tool_call_id"),
    )
    results = conversations.where("role = 'assistant'").select(
        "conv_id",
        "turn",
        F.lit("tool").alias("role"),
        "text",
        none.alias("tool_calls"),
        F.concat(F.lit("call-"), (turn - 1).cast("string")).alias("tool_call_id"),
    )
    return plain.unionByName(calls).unionByName(results)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return toolchat.formatted(tool_messages(conversations), {"lookup": LOOKUP})


def op10_chat_format_chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op10_chat_format, each call waiting for the result of the call before."""
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return toolchat.formatted(tool_messages(conversations, chained=True), {"lookup": LOOKUP})


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokenfiles.round_trip(documents, public_tokenizers.path(WORD_FILE), END_ID, ("ids_crc32",))


LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select(*LEAF_FIELDS)
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return merkle.manifest(
        documents,
        LEAF_FIELDS,
        tampered=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
        changes={"text": F.translate("text", capitals, capitals.lower())},
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.alignment(documents, public_tokenizers.path(BYTE_FILE), public_tokenizers.path(PIECE_FILE))


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_quality_rules": op3_quality_rules,
    "op4_secret_scans": op4_secret_scans,
    "op5_simhash": op5_simhash,
    "op6_warc": op6_warc,
    "op7_main_text": op7_main_text,
    "op8_decontamination": op8_decontamination,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_chat_format": op10_chat_format,
    "op11_token_files": op11_token_files,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_alignment": op13_token_alignment,
}

# Beside the one query of each operator.
MORE_QUERIES: dict[str, Query] = {"op10_chat_format_chained": op10_chat_format_chained}
