"""Columns of the user that are named like helper columns of the operators."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from demandloom.llm import bpe, licences, mixing, quality, registry, simhash, toxicity
from tests.llm.helpers import SF_DIR, as_set, no_documents, odd_documents

NAMES = [
    "source_key", "_key", "_range", "_before", "_value", "_inside", "_start", "_sum", "_round", "_k1", "_k2", "_words", "_body", "_rare",
    "_place", "_fp", "_name", "_row", "name", "key", "row", "root", "fp", "component", "component_id", "unnamed", "_codes", "c0", "c1", "c2",
    "word", "n", "place", "weight", "cap", "all", "caps", "u", "v", "node", "smallest", "with space", "dotted.name",
]


def extended(docs):
    """A column under every name, with values that follow from the row."""
    return docs.select("*", *[F.concat(F.lit(f"{name}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(name) for name in NAMES])


@pytest.fixture(scope="module")
def docs(spark):
    return odd_documents(spark)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")


OPERATORS = {
    "mix": lambda d: mixing.mix(d),
    "repeat_taken": lambda d: mixing.repeat_taken(mixing.mix(d), d.columns),
    "encode": lambda d: bpe.encode(d, registry.WORD_BPE),
    "encode_rare": lambda d: bpe.encode(d, registry.WORD_BPE, with_text=True, head_words=0),
    "decode": lambda d: bpe.decode(d.withColumn("ids", F.array(F.lit(320), F.lit(500))), registry.WORD_BPE),
    "drop_near_duplicates": lambda d: simhash.drop_near_duplicates(d),
    "scan": lambda d: licences.scan(d),
}


@pytest.mark.parametrize("operator", list(OPERATORS))
def test_operators_keep_them(docs, operator):
    own, more = OPERATORS[operator](docs), OPERATORS[operator](extended(docs))
    assert set(more.columns) == set(own.columns) | set(NAMES)
    assert as_set(more.select(*own.columns).collect()) == as_set(own.collect())
    for row in more.collect():
        assert all(row[name] == f"{name}:{'-' if row.doc_id is None else row.doc_id}" for name in NAMES)


def test_classifiers_keep_them(spark, docs, labels):
    texts = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for module, model in ((quality, quality.fit(texts, labels)), (toxicity, toxicity.fit(texts, labels))):
        own, more = module.score(docs, model), module.score(extended(docs), model)
        assert set(more.columns) == set(own.columns) | set(NAMES)
        assert as_set(more.select(*own.columns).collect()) == as_set(own.collect())


@pytest.fixture(scope="module")
def folder(spark, docs, labels, tmp_path_factory):
    """Documents with every awkward case and every name, beside the labelled ones of the small table."""
    path = str(tmp_path_factory.mktemp("odd"))
    small = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 1000)
    extended(docs.union(small.select(docs.columns))).write.parquet(f"{path}/documents.parquet")
    labels.withColumn("doc_id", F.col("doc_id") + 1000).write.parquet(f"{path}/labels.parquet")
    return path


def test_pipeline_with_every_name_and_awkward_rows(spark, folder):
    entered = spark.read.parquet(f"{folder}/documents.parquet")
    docs, counts = entered, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), name)
        assert docs.columns == entered.columns
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] > 0
    read = docs.collect()
    assert all((r.text or "").strip() for r in read) and all(r["_key"] == f"_key:{'-' if r.doc_id is None else r.doc_id}" for r in read)
    found = corpus_pipeline.run(spark, folder)
    assert set(found.columns) == set(entered.columns) - {"text"} | {"ids"}
    assert found.count() == len(read)


def test_pipeline_on_no_rows_and_on_repeated_ones(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(1, "some words here", "en", "a", 15)] * 20 + [(None, None, None, None, None)] * 5 + [(2, "", "en", "a", 0)] * 3
    for name, docs, kept in (("none", no_documents(spark), 0), ("same", spark.createDataFrame(rows, no_documents(spark).schema), 1)):
        path = str(tmp_path / name)
        docs.write.parquet(f"{path}/documents.parquet")
        none.write.parquet(f"{path}/labels.parquet")
        ids = {tuple(r.ids) for r in corpus_pipeline.run(spark, path).collect()}
        assert len(ids) == kept


def test_pipeline_without_a_length_column(spark):
    docs = odd_documents(spark).drop("n_chars").withColumn("size", F.lit(1))
    read = corpus_pipeline.mix_sources(spark, docs, SF_DIR)
    assert read.columns == docs.columns and read.where("size IS NOT NULL").count() == 0 and read.count() > 0
