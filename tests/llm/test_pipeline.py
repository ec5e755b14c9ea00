"""The pipeline's stages against plain code on the rows that each stage was given."""

from __future__ import annotations

from collections import defaultdict

import __spark_entry__ as contract
import corpus_pipeline
from orderloom.llm import decontamination, language, simhash, weak_labels
from tests.llm.test_simhash import groups

FOLDER = "/root/testdata/sf0.01"


def test_stages_against_plain_code(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], FOLDER).write.parquet(f"{tmp_path}/{name}")
        tables.append(spark.read.parquet(f"{tmp_path}/{name}"))
    assert all(table.columns == columns for table in tables[:-1])
    rows = [{r["doc_id"]: r["text"] for r in t.collect()} for t in tables[:-1]]

    scorer = weak_labels.fit(tables[0])
    assert rows[1] == {k: x for k, x in rows[0].items() if scorer.score(x) >= weak_labels.THRESHOLD}

    model = language.learn(tables[1])
    said = dict(zip(rows[1], language.judged(list(rows[1].values()), model)))
    assert rows[2] == {k: x for k, x in rows[1].items() if said[k][0] != "und" and said[k][1] >= language.MIN_SCORE}

    ids = sorted(rows[2])
    marks = [simhash.fingerprint(rows[2][k]) for k in ids]
    kept = {ids[group] for group in groups(marks)}
    assert rows[3] == {k: rows[2][k] for k in kept} and len(kept) < len(ids)

    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    search = decontamination.Search([(str(k), x) for k, x in items], decontamination.WINDOW)
    hit = {k for k, x in rows[3].items() if search.hits(decontamination.words_of(x))[0].any()}
    assert hit and rows[4] == {k: x for k, x in rows[3].items() if k not in hit}
    some = [(k, rows[3][k]) for k in [*sorted(hit)[:3], *sorted(rows[4])[:3]]]
    assert {r[0] for r in decontamination.brute_force(some, items) if r[-1]} == set(sorted(hit)[:3])

    packed = tables[5].collect()
    assert {r["doc_id"] for r in packed} == set(rows[4])
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        assert sorted(places)[0][0] == 0
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(places), sorted(places)[1:]))
        assert sum(n for _, n in places) <= 2048


def test_registered():
    names = contract.queries()
    assert names["pipeline"] is corpus_pipeline.run
    assert {f"op{k}_" for k in range(1, 11)} <= {name.split("_")[0] + "_" for name in names}
    assert corpus_pipeline.ORACLE_SQL is None


def test_a_run_is_the_same_twice(spark):
    one, other = (
        sorted(map(tuple, corpus_pipeline.run(spark, "/root/testdata/sf0.001").select("doc_id", "piece", "ids_crc32").collect()))
        for _ in range(2)
    )
    assert one == other
