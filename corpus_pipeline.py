"""The corpus pipeline: each stage works on all rows that the one before it kept.

1. quality: documents that the quality classifier rejects go;
2. toxicity: documents that are predicted toxic go;
3. near_duplicates: one document of each group of near-duplicates stays;
4. mixing: every source gives the words of its target, in as many readings as that takes;
5. bpe: the texts become token ids.

Every stage takes documents with nulls in any column, empty and very long texts, repeated
rows and doc_ids, and further columns under any names, which it keeps; an empty
table gives an empty one. Null and empty texts are judged like other texts, are
near-duplicates of each other, and have no words, so that the mix never reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm import bpe, mixing, quality, registry, simhash, toxicity
from demandloom.llm.common import load
from demandloom.session import materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier keeps; without labels of both classes it keeps or drops all. Equal rows go or stay together."""
    return quality.drop_poor(docs, load(spark, sf_dir, "labels"))


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not predicted toxic; without toxic labels all stay. Equal rows go or stay together."""
    return toxicity.drop_toxic(docs, load(spark, sf_dir, "labels"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints, that of the smallest doc_id; of repeated rows one."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document comes once for each time it is read; only a text that a source's budget cuts gets a new length.

    Texts without words are read by nobody. Columns named like those that the mix
    works out (size, source_size, target, budget, taken) come back as null.
    """
    mixed = mixing.mix(docs)
    worked_out = [c for c in docs.columns if c in ("size", "source_size", "target", "budget", "taken")]
    read = mixing.repeat_taken(mixed, [c for c in docs.columns if c not in worked_out])
    read = read.withColumns({c: F.lit(None).cast(docs.schema[c].dataType) for c in worked_out})
    if "n_chars" in docs.columns:
        read = read.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return read.select(*[F.col(f"`{c}`") for c in docs.columns])


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns but the text, and its ids; a column named ids or decoded is replaced."""
    return bpe.encode(docs, registry.WORD_BPE)


STAGES = [
    ("quality", keep_good),
    ("toxicity", keep_civil),
    ("near_duplicates", keep_distinct),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

#: The classifiers and the tokenizer have no equivalent in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of the documents that all stages keep, in as many rows as they are read; each stage's rows are stored."""
    docs = load(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = materialize(docs, name)
    return docs
