"""SimHash links and groups against comparing all pairs."""

from __future__ import annotations

import random

import numpy as np
import xxhash
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom.llm import simhash
from orderloom.llm.components import components
from tests.llm.data import documents


def groups(marks: list[int], bits: int = 3) -> list[int]:
    """The smallest place reachable from each."""
    root = list(range(len(marks)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(marks)):
        for b in range(a):
            if (marks[a] ^ marks[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(marks))]


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4))
def test_a_close_pair_keeps_its_budgets_from_some_segment(mark, flips):
    other = mark
    for bit in flips:
        other ^= 1 << bit
    chain = [(length * 4, bits) for length, bits in simhash.budgets(16, 3)]
    turned = lambda x, k: (x << k | x >> (64 - k)) & (2**64 - 1) if k else x
    found = any(
        len(simhash.near(np.uint64(turned(mark, 4 * k)), np.array([turned(other, 4 * k)], np.uint64), chain))
        for k in range(16)
    )
    assert found == (len(flips) <= 3)


def test_budgets():
    assert simhash.budgets(16, 3) == [(5, 0), (10, 1), (15, 2), (16, 3)]


def test_fingerprint_by_hand():
    text = "One two THREE four\tfive two three four"
    words = "one two three four five two three four".split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]).encode(), 42) for k in range(len(words) - 2)]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) == bits
    assert simhash.fingerprint("A b") == xxhash.xxh64_intdigest(b"a b", 42)
    assert simhash.fingerprint(" \n") == 0


def close_marks(seed: int) -> list[int]:
    rng = random.Random(seed)
    marks = {0}
    for _ in range(40):
        mark = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 30])):
            marks.add(mark)
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                mark ^= 1 << bit
    return sorted(marks)


def test_links_and_components_against_all_pairs(spark):
    marks = close_marks(1)
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    table = spark.createDataFrame([(m,) for m in signed], "fp long")
    for tile in (2, 4096):  # blocks split into many tiles, and not at all
        found = simhash.links(table, tile=tile).collect()
        assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 3 for a, b in found)
        root = components(spark.createDataFrame(found, "a long, b long"))
        label = {m: m for m in signed} | {row["node"]: row["root"] for row in root.collect()}
        expected = groups(marks)
        for a in range(len(marks)):
            for b in range(a):
                assert (label[signed[a]] == label[signed[b]]) == (expected[a] == expected[b])


def test_components_of_a_long_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7), (None, 3)]
    random.Random(3).shuffle(links)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(1, 61)} | {100 + k: 100 for k in range(1, 50)}


def test_documents_against_all_pairs(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    pairs = [(row["doc_id"], row["text"]) for row in rows] + [(10_000, None), (10_001, "")]
    marks = [simhash.fingerprint(text or "") for _, text in pairs]
    expected = {
        doc_id: (f"{mark:016x}", pairs[group][0])
        for (doc_id, _), mark, group in zip(pairs, marks, groups(marks))
    }
    found = simhash.near_duplicates(documents(spark, pairs).repartition(5)).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found} == expected
    kept = sorted(r["doc_id"] for r in simhash.one_per_group(documents(spark, pairs)).collect())
    assert kept == sorted(k for k, (_, group) in expected.items() if k == group)


def test_one_of_each_group_where_ids_repeat(spark):
    words = "ash birch cedar elm fir hazel ivy juniper larch maple oak pine rowan spruce willow yew".split()
    text = lambda seed: " ".join(random.Random(seed).choices(words, k=60))
    a, b, c, d, e = map(text, range(5))
    rows = [
        *((None, x) for x in (a, b, a)),  # groups of no id, one of them with a copy
        *((1, x) for x in (c, d)),  # unlike texts of one id
        *((2, x) for x in (c, e, e.upper())),  # a copy, and a group of one id
        (None, d),  # its group has an id
    ]
    marks = {x: simhash.fingerprint(x) for _, x in rows}
    assert len(set(groups(list(marks.values())))) == 5
    found = simhash.one_per_group(documents(spark, rows).repartition(4)).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "1", "2", "None", "None"]
    assert sorted(marks[r["text"]] for r in found) == sorted(set(marks.values()))
    assert {r["text"] for r in found if r["doc_id"] == 1} == {c, d}


def test_components_of_few_links_take_few_tasks(spark):
    """Each step writes a file for each core at most, whatever the number of shuffle partitions."""
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        links = spark.range(1, 400).select((F.col("id") - 1).alias("a"), F.col("id").alias("b"))
        found = components(links)
        assert {tuple(row) for row in found.collect()} == {(k, 0) for k in range(1, 400)}
        assert len(found.inputFiles()) <= spark.sparkContext.defaultParallelism
    finally:
        for key, value in was.items():
            spark.conf.set(key, value)
