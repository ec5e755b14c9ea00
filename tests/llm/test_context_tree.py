"""Context-tree scores against plain dictionaries."""

from __future__ import annotations

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest

from orderloom.llm import context_tree as ct
from tests.llm.data import PROSE, documents

ROWS = [(k, f"{PROSE[k:k + 60]} and {k % 4} more") for k in range(40)] + [(40, None), (41, "zzz qqq"), (42, PROSE)]


def plain(rows, depth):
    """By definition: counts per context and node, weights from the leaves up, mixing down."""
    streams = {k: ct.stream(text) for k, text in rows}
    learned = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 10]
    zeros, ones = defaultdict(int), defaultdict(int)

    def decisions(byte):
        return [((1 << bit) | (byte >> (8 - bit)), byte >> (7 - bit) & 1) for bit in range(8)]

    def steps(data):
        padded = ct.END * depth + data
        for at in range(depth, len(padded)):
            yield padded[at - depth : at], padded[at]

    for k in learned:
        for context, byte in steps(streams[k]):
            for node, bit in decisions(byte):
                for d in range(depth + 1):
                    (ones if bit else zeros)[context[depth - d :], node] += 1
    children = defaultdict(set)
    for context, node in {*zeros, *ones}:
        if context:
            children[context[1:], node].add(context)

    def own(key):
        a, b = zeros[key], ones[key]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    known = {}

    def weighted(context, node):
        key = context, node
        if key not in known:
            if len(context) == depth:
                known[key] = own(key)
            else:
                below = sum(weighted(c, node) for c in children[key])
                known[key] = np.logaddexp(own(key), below) + math.log(0.5)
        return known[key]

    def chance(context, node, d):
        key = context[depth - d :], node
        if not zeros[key] + ones[key]:
            return None
        mine = (ones[key] + 0.5) / (zeros[key] + ones[key] + 1)
        deeper = chance(context, node, d + 1) if d < depth else None
        if deeper is None:
            return mine
        share = math.exp(own(key) + math.log(0.5) - weighted(*key))
        return share * mine + (1 - share) * deeper

    out = {}
    for k, data in streams.items():
        total = 0.0
        for context, byte in steps(data):
            for node, bit in decisions(byte):
                p = chance(context, node, 0)
                p = 0.5 if p is None else p
                total += math.log10(p if bit else 1 - p)
        out[k] = total
    return out


@pytest.mark.parametrize("depth, chunk_bytes", [(5, 700), (3, 1 << 20)])
def test_against_plain_code(spark, depth, chunk_bytes):
    docs = documents(spark, ROWS).repartition(3)
    found = {r["doc_id"]: r for r in ct.context_tree_scores(docs, depth, chunk_bytes).collect()}
    expected = plain(ROWS, depth)
    assert {k: pytest.approx(v, rel=1e-9) for k, v in expected.items()} == {k: r["score"] for k, r in found.items()}
    words = defaultdict(int)
    for k, text in ROWS:
        if zlib.crc32(str(k).encode()) % 10:
            for word in [*(text or "").lower().split(), ""]:
                words[word] += 1
    total, distinct = sum(words.values()), len(words)
    for k, text in ROWS:
        tokens = [*(text or "").lower().split(), ""]
        base = sum(math.log10((words.get(w, 0) + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens)
        row = found[k]
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (
            len(tokens),
            sum(w in words for w in tokens),
            total,
        )
        assert row["held_out"] == (zlib.crc32(str(k).encode()) % 10 == 0)


def test_probabilities_add_up():
    """Over all bytes after a context the chances sum to one."""
    data = ct.stream(PROSE)
    runs, _ = ct.sorted_runs(data, np.array([len(data)]), 3)
    begins = ct.firsts(runs)
    counts = np.diff(np.append(begins, len(runs))).astype(float)
    context = runs[begins][5] >> np.uint64(8)
    every = np.union1d(runs[begins], (context << np.uint64(8)) | np.arange(256, dtype=np.uint64))
    weight = np.zeros(len(every))
    weight[np.searchsorted(every, runs[begins])] = counts
    tree = ct.Subtree(every, weight, 3)
    parts = tree.summary()
    keys = np.stack([parts["last"], parts["node"]], 1)
    rows = []
    for last, node in np.unique(keys, axis=0):
        mine = (parts["last"] == last) & (parts["node"] == node)
        rows.append({"last": last, "node": node} | {x: parts[x][mine].sum() for x in ("total", "ones", "weighted")})
    logs = tree.log_probability(ct.Top(rows))
    assert (10 ** logs[(every >> np.uint64(8)) == context]).sum() == pytest.approx(1)


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 3.25, 10, 1e3, 1e8])
    assert ct.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-11, abs=1e-11)


def test_better_than_words_on_unseen_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    row = ct.context_tree_scores(docs).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert row["s"] > row["b"]


def test_a_task_gathers_into_one_file(spark, monkeypatch):
    """What is asked and what is scored lie in columns of one file, not in files of their own."""
    paths = []
    fresh = ct.fresh_path
    monkeypatch.setattr(ct, "fresh_path", lambda *at: paths.append(fresh(*at)) or paths[-1])
    rows = documents(spark, ROWS).coalesce(1)
    assert ct.context_tree_scores(rows, buckets=3).count() == len(ROWS)
    gathered = spark.read.parquet(paths[0])
    assert len(gathered.inputFiles()) == 1
    kinds = gathered.selectExpr("runs IS NOT NULL AS r", "words IS NOT NULL AS w", "packed IS NOT NULL AS t")
    assert {tuple(row) for row in kinds.collect()} == {(True, False, False), (False, True, False), (False, False, True)}
