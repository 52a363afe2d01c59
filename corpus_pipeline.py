"""From raw documents to packed sequences: five stages, each written as Parquet and read by the next.

Every stage works on all rows that its predecessor kept. No SQL can express the whole (a learned language
model, a tokenizer), so ``ORACLE_SQL`` is None; the tests hold the documents that ``run`` keeps against a brute-force
version, and the operators against such versions of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import materialise, named, numbered, place
from tablesync.llm.language_id import fit, label
from tablesync.llm.mixing import mix
from tablesync.llm.ngram_join import keep_one
from tablesync.llm.packing import default_tokenizer, pack, written_place
from tablesync.llm.secret_scan import redact

#: A text goes if less than this share of its letters lies in spans of its main language.
LEAST_SHARE = 0.5
TEMPERATURE = 0.85


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with letters and a main language; the model is learned from all labelled rows. Where there are
    none, no language can be told and all documents with letters stay."""
    model = fit(docs)
    if not model.languages:
        return numbered(docs).filter(F.col(place(docs, "text")).rlike(r"\p{L}")).select(*named(docs))
    known = label(numbered(docs), model, place(docs, "text"))
    return known.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).select(*named(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by a Jaccard of 0.8 or more on five-word shingles."""
    return keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents, with secrets replaced by their kinds."""
    return redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix; those of sources below their weight come in more epochs."""
    keys = [place(docs, c) for c in ("doc_id", "text")]
    return mix(numbered(docs), temperature=TEMPERATURE, source=place(docs, "source"), rank_by=keys, in_order=True).select(*named(docs))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces with their token ids, numbered in the order in which the mix was written; workers, kept from stage to stage, hold little."""
    return pack(docs, default_tokenizer(), keep=1 << 18, batch=2 << 20, place=written_place(docs))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("mix_sources", mix_sources), ("pack_documents", pack_documents)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
