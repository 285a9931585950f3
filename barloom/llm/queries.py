"""One query per operator over the given tables, and SQL for those that it can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import oracles
from .align import aligned_documents
from .bpe import decode_documents, encode_documents
from .chunks import repeated_passages
from .common import table
from .contamination import contained_items
from .jaccard import jaccard_components
from .lines import clean_lines
from .packing import pack
from .ranking import best_documents, build_index
from .resampling import resample
from .secrets import find_secrets
from .toxicity import fit_toxicity, score_toxicity
from .warc import read_archives, write_archives
from .wavelet import read_shards, write_shards


def tokenizer(name):
    """The file of a public tokenizer; every machine of the cluster has the package that knows it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_wavelet_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return read_shards(write_shards(docs, tokenizer("word_bpe_49k.json"), end_id=2)).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op2_line_cleaning(spark, sf_dir):
    return clean_lines(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "lost_chars",
        "n_boilerplate",
        "n_navigation",
        "n_punctuation",
        F.sha2("clean_text", 256).alias("clean_sha256"),
    )


def op3_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pack(docs, tokenizer("byte_bpe_50k.json"), window=2048, end_id=1).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op4_toxicity(spark, sf_dir):
    def held_out():
        return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))

    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return score_toxicity(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
        "toxic",
    )


def op5_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"))


def op6_decontamination(spark, sf_dir):
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_warc(spark, sf_dir):
    return read_archives(write_archives(table(spark, sf_dir, "pages"), min_bytes=0)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_secret_scan(spark, sf_dir):
    return find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2("base_spans", 256).alias("base_sha256"),
        "spans",
        "n_layers",
    )


def op9_repeated_passages(spark, sf_dir):
    return repeated_passages(table(spark, sf_dir, "documents"))


def op10_resampling(spark, sf_dir):
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "log_weight", "sample_key", F.lit(True).alias("kept")
    )


def op11_token_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return aligned_documents(docs, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


def op12_ranked_search(spark, sf_dir):
    return best_documents(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), k=20)


def op13_bpe_prefix(spark, sf_dir):
    path = tokenizer("byte_bpe_50k.json")
    return decode_documents(encode_documents(table(spark, sf_dir, "documents"), path), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_wavelet_shards": op1_wavelet_shards,
    "op2_line_cleaning": op2_line_cleaning,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_decontamination": op6_decontamination,
    "op7_warc": op7_warc,
    "op8_secret_scan": op8_secret_scan,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_resampling": op10_resampling,
    "op11_token_alignment": op11_token_alignment,
    "op12_ranked_search": op12_ranked_search,
    "op13_bpe_prefix": op13_bpe_prefix,
}
ORACLES = oracles.ORACLES
