import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from demandloom.llm import quality, registry, toxicity
from demandloom.session import materialize
from tests.llm.helpers import SF_DIR, as_set
from tests.llm.test_mixing import brute_targets, size
from tests.llm.test_simhash import brute_fingerprint, brute_groups


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that enter each stage, and the last result."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF_DIR), name)
        tables.append(docs)
    return tables


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "mixing", "bpe"]
    assert all(t.schema == stages[0].schema for t in stages[1:-1])


def test_classifiers_decide(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    keep = quality.classify(stages[0], labels).where("keep = 1").select("doc_id")
    assert as_set(keep.collect()) == as_set(stages[1].select("doc_id").collect())
    civil = toxicity.classify(stages[1], labels).where("predicted = 0").select("doc_id")
    assert as_set(civil.collect()) == as_set(stages[2].select("doc_id").collect())
    good = stages[0].join(labels.where("quality = 1 AND toxic = 0"), "doc_id", "left_semi")
    assert good.join(stages[1], "doc_id", "left_semi").count() >= 0.98 * good.count()


def test_one_of_each_group_stays(stages):
    rows = stages[2].collect()
    groups = brute_groups([brute_fingerprint(r.text) for r in rows], 4)
    smallest = {}
    for group, row in zip(groups, rows):
        smallest[group] = min(smallest.get(group, row.doc_id), row.doc_id)
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(smallest.values())


def test_mix_meets_its_targets(stages):
    sizes, taken = {}, {}
    for r in stages[3].collect():
        sizes[r.source] = sizes.get(r.source, 0) + size(r.text)
    for r in stages[4].collect():
        taken[r.source] = taken.get(r.source, 0) + size(r.text)
        assert r.n_chars == len(r.text)
    targets = brute_targets(sizes)
    assert all(taken.get(s, 0) == int(targets[s] + 1e-9) for s in sizes)


def test_ids_are_the_librarys(stages):
    model = Tokenizer.from_file(registry.WORD_BPE)
    wanted = [(r.doc_id, tuple(model.encode(r.text, add_special_tokens=False).ids)) for r in stages[4].collect()]
    assert as_set((r.doc_id, tuple(r.ids)) for r in stages[5].collect()) == as_set(wanted)


def test_run_is_registered(spark, stages):
    found = entry.queries()["pipeline"](spark, SF_DIR)
    assert found.count() == stages[-1].count()


def test_every_operator_is_registered_once():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(registry.ORACLES) <= set(names)
