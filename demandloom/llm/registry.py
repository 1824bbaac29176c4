"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm import (
    alignment, bpe, licences, mixing, periodic, quality, secrets, sharding, simhash, syncmers, token_files, topk, toxicity,
)
from demandloom.llm.common import load
from demandloom.session import scratch_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(load(spark, sf_dir, "documents"), WORD_BPE)


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(load(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.cluster(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def top_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(load(spark, sf_dir, "embeddings"))


def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(load(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    token_files.write(load(spark, sf_dir, "documents"), folder, BYTE_BPE)
    return token_files.read(spark, folder, with_ids=False, digest=True)


def syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint(load(spark, sf_dir, "documents"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(load(spark, sf_dir, "documents"))


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(load(spark, sf_dir, "documents"))


def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digest(load(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


def secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(load(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": bpe_round_trip,
    "op2_simhash": simhash_components,
    "op3_mixing": mix_sources,
    "op4_topk": top_vectors,
    "op5_licences": licence_scan,
    "op6_token_files": token_id_files,
    "op7_syncmers": syncmer_fingerprints,
    "op8_quality": quality_scores,
    "op9_sharding": shard_documents,
    "op10_toxicity": toxicity_scores,
    "op11_periodic_runs": periodic_runs,
    "op12_alignment": token_alignment,
    "op13_secrets": secret_spans,
}

ORACLES: dict[str, str] = {
    "op3_mixing": mixing.ORACLE,
    "op4_topk": topk.ORACLE,
    "op5_licences": licences.oracle(),
}
