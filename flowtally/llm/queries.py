"""Registered queries of this package: (session, data folder) -> DataFrame over whole tables."""

from pyspark.sql import functions as F

from flowtally.llm import (
    alignment, bayeslsh, collocations, decontaminate, kneser, langid, licenses, linededup, packing, pst, sharding, simhash, spotsigs)
from flowtally.llm.common import table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name=TOKENIZER):
    """Place of a public vocabulary file; only its path is used."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_tree(spark, sf_dir):
    return pst.score_held_out(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark, sf_dir):
    docs = linededup.dedup_passages(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "n_lines", "removed_lines", "removed_chunks", "text")


def op3_quality(spark, sf_dir):
    return kneser.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)
    return pieces.drop("ids")


def op7_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_by_size(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op6_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_language_id(spark, sf_dir):
    return langid.predict_held_out(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score", F.size("spans").cast("bigint").alias("n_spans"))


def op9_spotsigs(spark, sf_dir):
    frame = spotsigs.fingerprints(table(spark, sf_dir, "documents"))
    return frame.select(
        "doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        spotsigs.digest("signatures").alias("fingerprint"),
        spotsigs.digest("edited_signatures").alias("edited_fingerprint"),
        spotsigs.likeness("signatures", "edited_signatures").alias("near_edited"),
        spotsigs.likeness("signatures", "next_signatures").alias("near_next"))


def op10_decontamination(spark, sf_dir):
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_alignment(spark, sf_dir):
    return alignment.align(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_minhash(spark, sf_dir):
    return bayeslsh.near_duplicates(table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    """All stages of corpus_pipeline.py, which imports this module."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_suffix_tree": op1_suffix_tree,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality": op3_quality,
    "op4_license_scan": op4_license_scan,
    "op5_packing": op5_packing,
    "op6_simhash": op6_simhash,
    "op7_sharding": op7_sharding,
    "op8_language_id": op8_language_id,
    "op9_spotsigs": op9_spotsigs,
    "op10_decontamination": op10_decontamination,
    "op11_collocations": op11_collocations,
    "op12_alignment": op12_alignment,
    "op13_minhash": op13_minhash,
    "pipeline": pipeline,
}
# The other operators use 64-bit hashes, trained models or token ids, which SQL lacks.
ORACLES = {"op4_license_scan": licenses.oracle(), "op11_collocations": collocations.oracle()}
