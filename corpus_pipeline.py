"""A training corpus from raw documents: filtered, deduplicated, decontaminated, masked and packed.

Each stage takes all that the one before it kept and is written as Parquet before the next one
reads it. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom.llm.common import save, table
from barloom.llm.contamination import decontaminate
from barloom.llm.jaccard import keep_one
from barloom.llm.packing import pack
from barloom.llm.queries import tokenizer
from barloom.llm.resampling import resample
from barloom.llm.secrets import mask_secrets
from barloom.session import work_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling takes, with the labelled good ones as the target."""
    return resample(docs, table(spark, sf_dir, "labels")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a shingle similarity of 0.75 or more."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets of every layer masked in their texts."""
    return mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with the ids of each piece."""
    return pack(docs, tokenizer("byte_bpe_50k.json"), window=2048, end_id=1)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: Models, decoding and tokens are beyond SQL; tests/llm/test_pipeline.py holds a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    root = work_path(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
