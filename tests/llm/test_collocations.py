"""Collocations against counting every phrase."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from orderloom.llm import bitmaps, collocations
from orderloom.llm.catalog import op11_collocations
from tests.compare import duck, mismatch
from tests.llm.data import documents, edge_rows


def brute_force(rows, min_count, top):
    counts, words = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            found = [w for w in re.split("[ \t]+", piece) if w]
            words[lang] += len(found)
            for size in range(1, 6):
                for k in range(len(found) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(found[k : k + size])] += 1
    for lang, table in counts.items():
        candidates = {p: a for p, a in table.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in candidates.items():
            score, _, l, r = min(
                (1000 * a * words[lang] // (table[p[:k]] * table[p[k:]]), k, table[p[:k]], table[p[k:]]) for k in range(1, len(p))
            )
            inside = any(
                len(q) > len(p) and b >= a and any(q[k : k + len(p)] == p for k in range(len(q) - len(p) + 1))
                for q, b in candidates.items()
            )
            if not inside:
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            yield lang, rank, phrase.decode(), -a, l, r, words[lang], -score


def same(found, rows, min_count, top):
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == sorted(brute_force(rows, min_count, top))


def prose(seed, count):
    """Few words, so that phrases repeat; one text a third of all rows; nulls and other langs."""
    pick = random.Random(seed)
    rows = [(0, "The Old house. the old house on the hill, the old house on the hill", "en")] * (count // 3)
    for k in range(count):
        words = pick.choices(["the", "old", "house", "on", "hill", "été", "a", "of", "漢字"], k=pick.randrange(0, 30))
        marks = pick.choices([" ", "  ", "\t", ". ", "\n", ",", " !"], [12, 1, 1, 1, 1, 1, 1], k=len(words))
        rows.append((k, "".join(map("".join, zip(words, marks))), pick.choice(["en", "en", "fr", None, "und", ""])))
    return rows


@pytest.mark.parametrize("budget, chunk, bits", [(1 << 20, 1 << 20, 1 << 27), (40, 50, 1 << 27), (3, 7, 64), (1, 1, 64)])
def test_equals_counting_all_phrases(spark, budget, chunk, bits):
    rows = prose(budget, 300)
    found = collocations.collocations(documents(spark, rows).repartition(3), 5, 2000, budget, chunk, bits)
    same(found, rows, 5, 2000)


@pytest.mark.parametrize("top", [1, 4])
def test_ties_at_the_last_rank(spark, top):
    rows = [(k, "b a, c d, d c, e f", "en") for k in range(3)]
    same(collocations.collocations(documents(spark, rows), 3, top), rows, 3, top)


def test_edges(spark):
    rows = [row for row in edge_rows() if row[0] != 10] * 3
    same(collocations.collocations(documents(spark, rows), 3), rows, 3, 2000)
    assert collocations.collocations(documents(spark, [])).collect() == []
    assert collocations.collocations(documents(spark, [(1, None, None), (2, "", "en")])).collect() == []


def test_words_the_worker_forgets(spark, monkeypatch):
    rows = prose(11, 120)
    monkeypatch.setattr(collocations, "WORDS_KEPT", 3)
    same(collocations.collocations(documents(spark, rows).coalesce(1), 4), rows, 4, 2000)


def test_matches_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert mismatch(op11_collocations(spark, folder), duck(folder), collocations.SQL) is None


def test_counts_beyond_64_bits(spark):
    count = 4 * 10**13
    phrases = spark.createDataFrame([([1, 2], count)], "words array<long>, n long")
    words = spark.createDataFrame([(1, "en", count + 1, 9 * 10**13), (2, "en", count + 2, 9 * 10**13)], "key long, lang string, f long, n long")
    row = collocations.scored(phrases, words).first()
    assert row["score"] == 1000 * count * 9 * 10**13 // ((count + 1) * (count + 2))


def test_a_bitmap_misses_nothing(spark):
    keys = spark.range(1000).selectExpr("xxhash64(id) AS key")
    values = np.array([r["key"] for r in keys.collect()], np.int64).view(np.uint64)
    for most in (64, 1 << 20):
        found = bitmaps.bitmap(keys, most)
        assert found.bits <= most and found.holds(values).all()
    others = values * np.uint64(0x9E3779B97F4A7C15) + np.uint64(12345)
    assert bitmaps.bitmap(keys).holds(others).mean() < 0.2
