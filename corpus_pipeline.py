"""A training corpus from ``documents`` in five stages.

1. language_id drops documents in no known language and writes the language found into ``lang``;
2. line_dedup removes repeated line chunks and runs of over 50 words from the texts;
3. near_dedup keeps one document (the least doc_id) of each group of near-duplicates;
4. mixing lays the documents out by training position, those read twice twice;
5. sentencepiece encodes the texts: (doc_id, n_tokens, ids, lossless).

Every stage works on all rows of the one before, written as Parquet in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatecast.llm import langid, line_chunks, mixing, probminhash, wfst
from slatecast.llm.common import quoted, store, table
from slatecast.llm.queries import TOKENIZERS

#: SQL can express neither the language model nor the encoder.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = langid.identify(docs, langid.fit(docs), docs["text"], docs["lang"], docs["source"], F.lit("source"))
    kept = found.filter("accepted")
    return kept.select(*[F.col("lang") if c == "lang" else F.col(f"doc.{quoted(c)}").alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_chunks.dedup_lines(docs)
    length = F.when(F.col("n_removed") > 0, F.length("doc.text")).otherwise(F.col("doc.n_chars")).cast("long")
    return cut.select(*[length.alias(c) if c == "n_chars" else F.col(f"doc.{quoted(c)}").alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return probminhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return wfst.encode_documents(docs, f"{TOKENIZERS}/piece_bpe_32k.model")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
