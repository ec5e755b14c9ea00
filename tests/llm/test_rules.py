"""Quality rules, URL rules and decontamination against SQL and against plain code."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderloom.llm import catalog, decontamination, quality_rules, url_rules
from tests.compare import duck, mismatch
from tests.llm.data import documents, edge_rows

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(catalog.llm_oracles()))
def test_matches_oracle(spark, name):
    result = catalog.llm_queries()[name](spark, FOLDER)
    assert mismatch(result, duck(FOLDER), catalog.llm_oracles()[name]) is None


@pytest.mark.parametrize("name", ["op1_quality_rules", "op10_decontamination"])
def test_matches_oracle_on_edges(spark, tmp_path, name):
    """A blank that regular expressions and Python see differently must not matter."""
    rows = [row for row in edge_rows() if "\x00" not in (row[1] or "") and len(row[1] or "") < 10_000]
    rows += [(20, "a b c d a b c x\r\ny\x0by\x0c"), (21, "…\n- x\n* y\nz...\n- x\n"), (22, "the word The-word é")]
    documents(spark, rows).select("doc_id", "text").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, "the word the word"), (1, "word é"), (2, "word"), (None, "b c"), (3, None), (4, "...")]
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    result = catalog.llm_queries()[name](spark, str(tmp_path))
    if name == "op1_quality_rules":
        assert mismatch(result, duck(str(tmp_path)), catalog.llm_oracles()[name]) is None
    else:
        plain = decontamination.brute_force([(r[0], r[1]) for r in rows], items)
        assert Counter(map(tuple, result.collect())) == Counter(plain)


@settings(deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c", b"dd"]), max_size=40))
def test_repeated_words(words):
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {
        k + shift
        for k, window in enumerate(zip(words, words[1:], words[2:]))
        if windows[window] > 1
        for shift in range(3)
    }
    assert quality_rules.repeated_words(words) == len(inside)


def test_cascade_order_and_short_circuit():
    figures = [
        {"name": "slow", "seconds": 10.0, "rejected": 50, "seen": 100},
        {"name": "keen", "seconds": 1.0, "rejected": 40, "seen": 100},
        {"name": "idle", "seconds": 1.0, "rejected": 0, "seen": 100},
    ]
    asked = []
    rule = lambda name, verdict: quality_rules.Rule(name, lambda f: asked.append(name) or verdict)
    rules = (rule("slow", False), rule("idle", False), rule("keen", True), rule("new", False))
    order = quality_rules.cascade_order(figures, rules)
    assert [r.name for r in order] == ["keen", "slow", "idle", "new"]
    assert not quality_rules.passes(quality_rules.Facts("x"), order) and asked == ["keen"]


def test_any_order_keeps_the_same(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = lambda rules: quality_rules.quality_rules(docs, rules).where("kept").count()
    assert kept(quality_rules.RULES) == kept(quality_rules.RULES[::-1])


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.text("abc ", max_size=30), min_size=1, max_size=6),
    st.lists(st.text("abc ", max_size=12), max_size=5),
    st.integers(1, 4),
)
def test_search_against_every_position(docs, items, window):
    named = [(str(k), item) for k, item in enumerate(items)]
    search = decontamination.Search(named, window)
    plain = decontamination.brute_force(list(enumerate(docs)), named, window)
    for text, (_, n_words, n_hit, n_items, *_) in zip(docs, plain):
        inside, names = search.hits(decontamination.words_of(text))
        assert (len(inside), int(inside.sum()), len(names)) == (n_words, n_hit, n_items)


def test_blocks_of_the_benchmark_give_the_same(spark):
    rng = random.Random(2)
    word = lambda: rng.choice("ab")
    docs = [(k, " ".join(word() for _ in range(60))) for k in range(30)] + [(99, None)]
    items = [(k, " ".join(word() for _ in range(rng.randint(0, 14)))) for k in range(25)]
    plain = Counter(decontamination.brute_force(docs, items))
    table = spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 20, 90):
        found = decontamination.digest(decontamination.decontaminate(documents(spark, docs), table, block_bytes=block))
        assert Counter(map(tuple, found.collect())) == plain
        clean = decontamination.clean_documents(documents(spark, docs), table, block_bytes=block)
        assert {r["doc_id"] for r in clean.collect()} == {row[0] for row in plain if not row[-1]}


def test_repeated_items_are_held_once_and_blocks_one_by_one(spark):
    items = [(1, "one two three four")] * 500 + [(k, f"item {k} of the benchmark text") for k in range(40)]
    table = spark.createDataFrame(items, "item_id long, text string")
    blocks = decontamination.blocks_of(table, 300)
    first, last = next(blocks)
    assert not last and len(first) < 30
    rest = list(blocks)
    assert [last for _, last in rest] == [False] * (len(rest) - 1) + [True]
    assert sorted(first + [item for block, _ in rest for item in block]) == sorted({(str(k), text) for k, text in items})


URLS = [
    "http://com/", "http://a.com/x", "http://xcom/", "HTTP://EXAMPLE.com/en/1", "http://www.example.com/en/1",
    "http://a.www.example.com/en/", "http://example.com/EN/", "http://example.com/en", "http://b.net/es/?q",
    "http://net/fr/", "http://net/fr#x", "x://q://net/es/", "http://net?/es/", "http://u@net:80/es/",
    "http://a b.net/es/", "http://poker.org/", "http://x.org/Poker/1", "http://x.org/pokers", "http://x.com/casino",
    "http://x.net/a.xxx", "://net/es/", "http://", "http:///es/",
]


def verdict(url: str) -> tuple:
    head, found, rest = url.partition("://")
    if not found:
        return "", "", None, "allow"
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = rest[:cut].translate(str.maketrans(url_rules.UPPER, url_rules.LOWER))
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [
        (len(name), name, decision)
        for decision, name in url_rules.LIST_RULES
        if (host == name.split("/")[0] or host.endswith("." + name.split("/")[0]))
        and path.startswith("/" + name.partition("/")[2])
    ]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in f"{host} {path}".lower()).split()
    listed = host and any(rule.tokens[0] in words for rule in url_rules.PATTERN_RULES)
    return host, path, None, "block" if listed else "allow"


def test_urls_against_plain_code(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.url_verdicts(pages).collect()}
    assert found == {k: verdict(url) for k, url in enumerate(URLS)}


def test_url_plan_is_native_and_runs_patterns_on_fetched_rules(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    plan = url_rules.url_verdicts(pages)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
    assert "html" not in plan


def test_rarest_token_is_the_key(spark):
    rules = (url_rules.UrlRule("r", "block", "common", ("common", "rare")),)
    rows = [(k, f"http://common/{k}") for k in range(5)] + [(9, "http://common/rare")]
    found = url_rules.url_verdicts(spark.createDataFrame(rows, "page_id long, url string"), rules)
    assert {r["page_id"] for r in found.where("matched = 'r'").collect()} == {9}
    with pytest.raises(ValueError):
        url_rules.url_verdicts(found.selectExpr("page_id", "host url"), (url_rules.UrlRule("r", "block", "x", ()),))
