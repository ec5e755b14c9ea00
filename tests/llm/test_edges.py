"""Nulls, empty and very long texts, repeated rows, clashing columns and empty tables."""

from __future__ import annotations

import pytest

import corpus_pipeline
from orderloom.llm import (
    binary_records,
    context_tree,
    decontamination,
    language,
    packing,
    quality_rules,
    simhash,
    toxicity,
    url_rules,
    weak_labels,
)
from tests.llm.data import documents, edge_rows

LABELS = "doc_id long, quality int, toxic int, text string"
ITEMS = "item_id long, text string, words string"


def labels(spark, rows=((5, 1, 0, "x"), (5, 1, 1, "x"), (None, 1, 1, "x"), (4, None, None, None))):
    return spark.createDataFrame(list(rows), LABELS)


def items(spark, rows=((1, None, "w"), (None, "any longer", "w"), (2, "", "w"), (3, "word", "w"))):
    return spark.createDataFrame(list(rows), ITEMS)


OPERATORS = {
    "quality_rules": lambda spark, docs: quality_rules.quality_rules(docs),
    "context_tree": lambda spark, docs: context_tree.context_tree_scores(docs),
    "simhash": lambda spark, docs: simhash.near_duplicates(docs),
    "binary_records": lambda spark, docs: binary_records.round_trip(docs),
    "packing": lambda spark, docs: packing.pack(docs).where("piece = 0"),
    "weak_labels": lambda spark, docs: weak_labels.weak_label_scores(docs),
    "language": lambda spark, docs: language.identify(docs),
    "toxicity": lambda spark, docs: toxicity.toxicity(docs, labels(spark)),
    "decontamination": lambda spark, docs: decontamination.digest(
        decontamination.decontaminate(docs, items(spark))
    ),
}


@pytest.fixture(scope="module")
def results(spark):
    docs = documents(spark, edge_rows())
    return {name: run(spark, docs).collect() for name, run in OPERATORS.items()}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_result_per_row(results, name):
    ids = sorted(str(row["doc_id"]) for row in results[name])
    assert ids == sorted(str(row[0]) for row in edge_rows())


@pytest.mark.parametrize("name", OPERATORS)
def test_repeated_rows_get_the_same(results, name):
    """Apart from the places of records and pieces, which are each row's own."""
    own = {"start", "sequence_id", "offset"}
    first, second = (
        {k: v for k, v in row.asDict().items() if k not in own} for row in results[name] if row["doc_id"] == 5
    )
    assert first == second


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, documents(spark, [])).collect() == []


def test_defined_values(results):
    by_id = lambda name: {row["doc_id"]: row for row in results[name]}
    rules = by_id("quality_rules")
    assert [rules[k]["n_words"] for k in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert rules[1]["base_failed"] and not rules[1]["kept"] and rules[5]["kept"]
    marks = by_id("simhash")
    assert {marks[k]["fingerprint"] for k in (1, 2, 3)} == {"0" * 16}
    assert {marks[k]["component_id"] for k in (1, 2, 3)} == {1} and marks[6]["component_id"] == 5
    records = by_id("binary_records")
    assert [records[k]["n_tokens"] for k in (1, 2)] == [1, 1]
    assert by_id("packing")[1]["length"] == 1
    said = by_id("language")
    assert [said[k]["lang_pred"] for k in (1, 2, 3, 7)] == ["und"] * 4 and said[6]["lang_pred"] == "en"
    assert all(0 <= row["score"] <= 1 for row in [*results["language"], *results["toxicity"]])
    clean = by_id("decontamination")
    assert clean[4]["n_items"] == 1 and clean[4]["contaminated"]
    assert clean[5]["n_hit"] == 2 and clean[5]["n_items"] == 0  # an item without id has no name
    tree = by_id("context_tree")
    assert tree[1]["n_tokens"] == 1 and tree[1]["score"] == tree[2]["score"] < 0
    assert not any(row["held_out"] for row in results["context_tree"] if row["doc_id"] is None)


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "some text", None), (2, None, None)])
    assert {row["lang_pred"] for row in language.identify(docs).collect()} == {"und"}
    scored = toxicity.toxicity(docs, labels(spark, ())).collect()
    assert {row["predicted"] for row in scored} == {0}
    found = decontamination.decontaminate(docs, items(spark, ())).collect()
    assert {row["n_hit"] for row in found} == {0}


def test_urls(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "no scheme/en/", "x"), (None, "http://A.com", "x"), (5, "http://a.com/", "x")]
    pages = spark.createDataFrame([*rows, rows[-1]], "page_id long, url string, token string")
    found = url_rules.url_verdicts(pages).collect()
    assert sorted((str(r["page_id"]), r["host"], r["path"], r["rule"], r["verdict"]) for r in found) == [
        ("1", "", "", None, "allow"),
        ("2", "", "", None, "allow"),
        ("3", "", "", None, "allow"),
        ("5", "a.com", "/", "com/", "allow"),
        ("5", "a.com", "/", "com/", "allow"),
        ("None", "a.com", "", None, "allow"),
    ]
    assert url_rules.url_verdicts(pages.limit(0)).collect() == []


@pytest.mark.parametrize("rows", [edge_rows(), []], ids=["edges", "empty"])
def test_pipeline_stages(spark, tmp_path, rows):
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark, rows)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{tmp_path}/{name}"
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        if rows and name == "simhash_near_dedup":
            kept = [row["doc_id"] for row in docs.collect()]
            assert kept.count(5) == 1 and 6 not in kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert packed.where("piece = 0").count() == docs.count()
