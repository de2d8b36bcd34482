"""The operators as registered queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def op8_decontaminate(spark: SparkSession, directory: str) -> DataFrame:
    from storelens.llm.decontam import RESULT, decontaminate

    docs = _table(spark, directory, "documents").select("doc_id", "text")
    judged, _ = decontaminate(docs, _table(spark, directory, "benchmark"), carry=("_row",))
    return judged.select(F.col("_row.doc_id").alias("doc_id"), *[c for c in RESULT if c != "n_near"])


def op8_proximity(spark: SparkSession, directory: str) -> DataFrame:
    """Benchmark items near to each document, exact matches included; beside op8_decontaminate, whose columns its SQL fixes."""
    from storelens.llm.decontam import decontaminate

    docs = _table(spark, directory, "documents").select("doc_id", "text")
    judged, _ = decontaminate(docs, _table(spark, directory, "benchmark"), carry=("_row",))
    return judged.select(F.col("_row.doc_id").alias("doc_id"), "n_near")


def op1_quality(spark: SparkSession, directory: str) -> DataFrame:
    from storelens.llm.quality import score_quality

    scored = score_quality(_table(spark, directory, "documents").select("doc_id", "text"), _table(spark, directory, "labels"), carry=("_row",))
    held_out = F.coalesce(F.pmod(F.crc32(F.col("_row.doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    return scored.select(F.col("_row.doc_id").alias("doc_id"), held_out.alias("held_out"), "score", "predicted")


#: A conversation whose texts hold the template's own control strings.
OP2_EXTRA = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op2_chat(spark: SparkSession, directory: str) -> DataFrame:
    from storelens.llm.chat import conversation_records, digests, format_records

    rows = _table(spark, directory, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    rows = rows.unionByName(spark.createDataFrame(OP2_EXTRA, "conv_id long, turn long, role string, text string"))
    return digests(format_records(conversation_records(rows)))


def op3_licenses(spark: SparkSession, directory: str) -> DataFrame:
    from storelens.llm.licenses import RESULT, scan_licenses

    found = scan_licenses(_table(spark, directory, "documents").select("doc_id", "text"), carry=("_row",))
    return found.select(F.col("_row.doc_id").alias("doc_id"), *[c for c in RESULT if c != "matched_words"])


def op4_quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    from storelens.llm.rules import judge

    docs = _table(spark, directory, "documents").select("doc_id", "text", "lang")
    judged = judge(docs, _table(spark, directory, "labels"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(F.col("_row.doc_id").alias("doc_id"), *base, F.concat_ws(",", "failed_rules").alias("failed_rules"))


def op5_pack(spark: SparkSession, directory: str) -> DataFrame:
    from storelens.llm.packing import pack

    return pack(_table(spark, directory, "documents").select("doc_id", "text"))


#: Three edits of each document: its source inserted in the middle, a passage deleted, its beginning replaced by its language.
OP9_EDITS = """array(
    named_struct('pos', char_length(_text) div 2, 'deleted', 0L, 'inserted', concat(' [', coalesce(_row.source, ''), ']')),
    named_struct('pos', char_length(_text) div 4, 'deleted', 25L, 'inserted', ''),
    named_struct('pos', 0L, 'deleted', 5L, 'inserted', coalesce(_row.lang, '')))"""


def op6_html(spark: SparkSession, directory: str) -> DataFrame:
    from storelens.llm.html import extract_pages

    found = extract_pages(_table(spark, directory, "pages").select("page_id", "url", "html"))
    return found.select(F.col("_row.page_id").alias("page_id"), F.col("_row.url").alias("url"), "text", "n_chars")


def op7_language(spark: SparkSession, directory: str) -> DataFrame:
    from storelens.llm.language import identify

    found = identify(_table(spark, directory, "documents").select("doc_id", "text", "lang"), carry=())
    held_out = F.coalesce(F.pmod(F.crc32(F.col("_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    return found.select(F.col("_id").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op9_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    from storelens.llm.token_counts import apply_edits, count_tokens

    docs = _table(spark, directory, "documents").select("doc_id", "text", "lang", "source")
    edited = apply_edits(count_tokens(docs), OP9_EDITS, carry=("_row",))
    return edited.select(F.col("_row.doc_id").alias("doc_id"), "n_tokens", "n_tokens_edited", "n_chars_edited", "n_chars_encoded", "n_leaves")


def op10_simhash(spark: SparkSession, directory: str) -> DataFrame:
    from storelens.llm.simhash import near_copies

    found = near_copies(_table(spark, directory, "documents").select("doc_id", "text"), carry=())
    return found.select(F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: What a leaf of the manifest is made of.
OP11_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle(spark: SparkSession, directory: str) -> DataFrame:
    """Proofs of all documents, checked against a copy of the table in which every third document is tampered with."""
    from storelens.llm.merkle import folded, leaf, manifest, proof_digest, tampered

    docs = _table(spark, directory, "documents").select(*OP11_FIELDS)
    changed = leaf([tampered(F.col(c)) if c == "text" else F.col(c) for c in OP11_FIELDS])
    later = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, changed)
    built = manifest(docs, OP11_FIELDS, carry={"later": later})
    rows = built.proofs()
    rows = rows.select(F.col("key").alias("doc_id"), "leaf", "subroot", F.lit(built.root).cast("string").alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
                       folded(F.coalesce("later", "leaf"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_whitening(spark: SparkSession, directory: str) -> DataFrame:
    from storelens.llm.whitening import whiten

    return whiten(_table(spark, directory, "embeddings").select("vec_id", "embedding"))


def op13_minhash(spark: SparkSession, directory: str) -> DataFrame:
    from storelens.llm.minhash import near_copies

    found = near_copies(_table(spark, directory, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def registered() -> dict[str, Query]:
    return {"op1_quality": op1_quality, "op2_chat": op2_chat, "op3_licenses": op3_licenses, "op4_quality_rules": op4_quality_rules, "op5_pack": op5_pack, "op6_html": op6_html, "op7_language": op7_language, "op8_decontaminate": op8_decontaminate, "op8_proximity": op8_proximity, "op9_token_counts": op9_token_counts, "op10_simhash": op10_simhash, "op11_merkle": op11_merkle, "op12_whitening": op12_whitening, "op13_minhash": op13_minhash}
