"""Corpus pipeline: from raw documents to packed training sequences.

The stages run in order, each over all that the one before it kept; every one but the last returns
the columns of ``documents``.

1. ``toxicity``: documents scored as toxic go (learned from ``labels`` on documents that are not held out).
2. ``near_duplicates``: of each group of near copies (five-word shingles, similarity 0.8 or more) one document stays,
   the smallest doc_id (null last); every row is a document, whatever other rows have its id, so no text goes
   without a near copy that stays; rows without words stay.
3. ``pii``: confirmed spans give way to their kind in the text, and n_chars follows.
4. ``mix``: documents are repeated or left out until sources take their target shares.
5. ``pack``: texts become token pieces, placed in sequences of 4096 tokens; each piece has its token ids.

Cases: null and empty texts pass every stage, the mix repeating them at their source's rate; repeated
rows, ties, empty tables and other columns as each operator's module states.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pitchside.llm import mixing, neardup, packing, pii, toxicity
from pitchside.llm.common import table
from pitchside.session import ensure_checkpoint_dir

#: SQL has neither a compressor nor the tokenizer; tests/llm/test_pipeline.py compares with a plain version.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    plain = docs.withColumnsRenamed({c: f"_{c}" for c in ("score", "predicted") if c in docs.columns})
    kept = toxicity.score_toxicity(plain, model).where("predicted = 0").select(*plain.columns)
    return kept.toDF(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs, percent=80)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact_pii(docs).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit_copies(mixing.mix_sources(docs)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("pii", without_pii),
    ("mix", mixed),
    ("pack", packed),
]


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents with their token ids.

    What lies between two stages is kept in the shared folder until the next stage's is written; the last stage
    puts its pieces in a checkpoint of its own before it returns.
    """
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            delete(spark, f"{folder}/{k - 1}")
    delete(spark, folder)
    return docs
