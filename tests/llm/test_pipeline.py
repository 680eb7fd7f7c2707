"""The corpus pipeline against brute force, and the registered queries."""

import importlib.util
from pathlib import Path

import pytest

import corpus_pipeline
from tessera.llm import queries, sentencepiece_fst
from tessera.llm.common import documents
from tools.oracle_check import duck

from .test_dedup import brute, shingle_set
from .test_text import trained

SF = "/root/testdata/sf0.001"


def test_stages_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "decontamination", "sentencepiece"]


def test_pipeline_is_brute_force(spark):
    d = documents(spark, SF)
    rows = [(r["doc_id"], r["text"]) for r in d.collect()]
    latest = {}
    for i, t in rows:                                    # all documents have letters, none is rejected
        latest[t] = max(i, latest.get(t, i))
    rows = [(i, t) for t, i in latest.items()]
    classes = brute(rows)
    rows = [(i, t) for i, t in rows if classes[i][0] == i]
    items = [shingle_set(r["text"]) for r in documents(spark, SF, "benchmark").collect()]
    leaked = lambda t: any(len(shingle_set(t) & s) >= 0.8 * len(s) for s in items if s)
    want = {i: t for i, t in rows if not leaked(t)}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(want) and 0 < len(want) < 200
    fst = sentencepiece_fst.Transducer(sentencepiece_fst.read_model())
    assert all(fst.decode(got[i]["ids"]) == t and got[i]["round_trip"] for i, t in want.items())


def test_stages_keep_the_columns(spark):
    d = documents(spark, SF).limit(30)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, d, SF).dtypes == d.dtypes


def test_registered():
    spec = importlib.util.spec_from_file_location("entry_llm", Path(__file__).resolve().parents[2] / "__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    names = set(entry.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    want = duck(SF).sql(queries.ORACLE[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()[list(want.columns)]
    order = list(want.columns)
    text = lambda df: df.sort_values(order).reset_index(drop=True).convert_dtypes().astype(str)
    assert text(got).equals(text(want))                  # a long with nulls is a float to one of the two readers


def test_last_stage_composes_the_normaliser_and_decodes(spark, tmp_path, monkeypatch):
    _, _, path = trained(tmp_path, "m", model_type="bpe", normalization_rule_name="nfkc")
    model = sentencepiece_fst.read_model(path)
    monkeypatch.setattr(sentencepiece_fst, "read_model", lambda path=None: model)
    d = spark.createDataFrame([(1, "the cat"), (2, "ﬁne")], "doc_id long, text string")
    got = {r["doc_id"]: (r["ids"], r["round_trip"]) for r in dict(corpus_pipeline.STAGES)["sentencepiece"](spark, d, SF).collect()}
    fst = sentencepiece_fst.Transducer(model)
    assert got == {1: (fst.encode("the cat"), True), 2: (fst.encode("fine"), False)}
