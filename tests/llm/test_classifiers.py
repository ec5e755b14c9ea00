"""Weak labels, language and toxicity: parts against plain code, the whole on held-out rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom.llm import language, toxicity, weak_labels
from tests.llm.data import PROSE

FOLDER = "/root/testdata/sf0.1"


def table(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def test_label_model_finds_the_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(200_000) < 0.8
    hit, false = [0.9, 0.7, 0.5, 0.6], [0.02, 0.05, 0.01, 0.1]  # chances of a bad vote
    pattern = np.zeros(len(good), np.int64)
    for a, b in zip(hit, false):
        bad = rng.random(len(good)) < np.where(good, b, a)
        pattern = 3 * pattern + np.where(bad, weak_labels.BAD, weak_labels.SILENT)
    counts = {int(k): int(n) for k, n in zip(*np.unique(pattern, return_counts=True))}
    model = weak_labels.fit_labels(counts, 4, rounds=500)
    assert model.prior == pytest.approx(0.8, abs=0.02)
    assert model.chance[:, weak_labels.BAD, weak_labels.BAD] == pytest.approx(hit, abs=0.03)
    assert model.chance[:, weak_labels.GOOD, weak_labels.BAD] == pytest.approx(false, abs=0.03)


def test_votes_are_digits():
    count = len(weak_labels.LABELLERS)
    cast = weak_labels.digits(np.array([weak_labels.votes(PROSE), weak_labels.votes("A!! " * 30)]), count)
    assert (cast[0] != weak_labels.BAD).all() and (cast[0] == weak_labels.GOOD).sum() == 4
    assert (cast[1] == weak_labels.BAD).sum() >= 3


def test_training_separates():
    samples = [([1, 2], [1.0, 0.5], 0.95)] * 20 + [([3, 2], [1.0, 0.5], 0.05)] * 20
    scorer = weak_labels.train(samples)
    chance = lambda at: 1 / (1 + math.exp(-scorer.weights[at].sum() - scorer.bias))
    assert chance([1]) > 0.8 and chance([3]) < 0.2


def test_quality_on_labels(spark):
    found = weak_labels.weak_label_scores(table(spark, "documents")).join(table(spark, "labels"), "doc_id")
    rows = found.groupBy("quality").agg(F.avg("score").alias("score"), F.avg(F.col("kept").cast("int")).alias("kept"))
    means, kept = ({r["quality"]: r[name] for r in rows.collect()} for name in ("score", "kept"))
    assert means[1] > 0.9 > 0.1 > means[0]
    assert kept[1] > 0.99 and kept[0] < 0.1


def test_shapes_of_whole_words():
    assert weak_labels.shape("漢字。" * 3 + "x" * 100 + "#") == "a。a。a。a#"
    assert weak_labels.shape("Word" + "," * 80 + "7") == "Aa,0"
    clean = "这是一个句子，" * 40
    of = lambda text: dict(zip(*(x.tolist() for x in weak_labels.features(text))))
    marks = [of(clean), of(clean + "#$%" * 40), of(clean + "7#" * 90)]
    step = weak_labels._bucket("3 # $")
    assert step in marks[1] and step not in marks[0] and marks[2].keys() - marks[0].keys()
    assert of("a line of words, and 7 more of them.").keys() == of("a line of words, and 9 more of them.").keys()


def test_junk_in_unspaced_text_is_told():
    rng = np.random.default_rng(2)
    hanzi = [chr(0x4E00 + k) for k in range(300)]
    said = lambda: "".join("".join(rng.choice(hanzi, rng.integers(4, 12))) + "，。"[k % 2] for k in range(60))
    signs = lambda: "".join(rng.choice(list("#$%^*~"), 300))
    good, bad = [said() for _ in range(60)], [said() + signs() for _ in range(60)]
    train = [weak_labels.features(x) for x in (good + bad)]
    scorer = weak_labels.train([(a.tolist(), v.tolist(), float(k < 60)) for k, (a, v) in enumerate(train)])
    assert min(scorer.score(said()) for _ in range(20)) > 0.8
    assert max(scorer.score(said() + signs()) for _ in range(20)) < 0.2


@settings(deadline=None)
@given(st.binary(max_size=40).map(lambda b: bytes(x % 4 + 97 for x in b)))
def test_suffix_automaton_knows_the_substrings(data):
    steps = language.suffix_automaton(data)

    def knows(word):
        state = 0
        for byte in word:
            if byte not in steps[state]:
                return False
            state = steps[state][byte]
        return True

    parts = {data[a:b] for a in range(len(data)) for b in range(a + 1, len(data) + 1)}
    assert all(map(knows, parts))
    assert not any(knows(p + bytes([c])) for p in parts for c in b"abcd" if p + bytes([c]) not in data)


def test_a_verdict_does_not_depend_on_how_rows_lie(spark):
    """Other files, other order, other tasks, and a text that a third of the rows repeat."""
    rows = [(row["doc_id"], row["text"]) for row in table(spark, "documents").where("doc_id % 7 = 0").select("doc_id", "text").collect()]
    rows += [(-k, rows[0][1]) for k in range(1, len(rows) // 2)]
    pick = random.Random(2)
    results = []
    for parts in (1, 7):
        pick.shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        found = weak_labels.weak_label_scores(docs, train_rows=500).collect()
        results.append({row["doc_id"]: (row["score"], row["kept"]) for row in found})
    assert results[0] == results[1]


@pytest.mark.parametrize("kinds", [63, 64, 65, 200])
def test_words_of_many_kinds_keep_their_shape(kinds):
    word = ("a1" * kinds)[:kinds]
    assert weak_labels.shape(word) == word.replace("1", "0")
    at, _ = weak_labels.features(word)
    other, _ = weak_labels.features(word[:-1] + "#")
    assert set(at) != set(other)


def greedy(sample, stream):
    """Longest phrases of a whole text; a byte that the sample lacks is a phrase and stays out of the next."""
    count, phrase = 0, b""
    for byte in stream:
        if phrase + bytes([byte]) in sample:
            phrase += bytes([byte])
        else:
            count += 1
            phrase = bytes([byte]) if byte in sample else b""
    return count


def same_phrases(samples, streams):
    model = language.Model(tuple((str(k), sample) for k, sample in enumerate(samples)))
    found = language.Parser(model).phrases(streams)
    assert found.tolist() == [[greedy(s, x.tobytes()) for s in samples] for x in streams]


def test_phrases_by_hand():
    texts = ["the cat on the mat " * 30, "Der Hund!", "xyz", ""]
    streams = [language.normalised(text) for text in texts]
    same_phrases([b"the cat sat on the mat", b"der hund lag auf der matte"], streams)
    assert language.normalised("A1, b é").tobytes() == "a b é".encode()


def test_phrases_go_on_over_the_ends_of_segments():
    """Texts around the borders, and copies of the sample, which are one phrase over many segments."""
    pick = random.Random(1)
    samples = ["".join(pick.choices("abc de", k=n)).encode() for n in (3000, 500)] + [b"abababababab" * 60]
    sizes = [k * language.SEGMENT + d for k in (1, 2, 5) for d in (-1, 0, 1)] + [0, 1, 2, 3000]
    texts = ["".join(pick.choices("abc dexé", k=size)).encode() for size in sizes]
    texts += [samples[0], samples[2], samples[2] * 3 + samples[0], samples[0][100:] + b"?" + samples[0], b"ab" * 2000]
    same_phrases(samples, [np.frombuffer(text, np.uint8) for text in texts])


def test_languages_of_held_out_documents(spark):
    found = language.identify(table(spark, "documents")).where("held_out")
    both = found.join(table(spark, "documents").select("doc_id", "lang"), "doc_id").toPandas()
    assert len(both) > 1500 and (both.lang == both.lang_pred).mean() > 0.99
    assert both.score.between(0, 1).all()


def test_languages_of_many_copies_are_learned(spark):
    words = {"en": "the cat sat on a mat", "fr": "le chat dort sous la table", "de": "der hund liegt auf dem sofa"}
    texts = [(lang, f"{said} {k}{k} {said}") for lang, said in words.items() for k in range(40)]
    rows = [(lang, text) for lang, text in texts] + [("fr", "une copie de plus")] * 60_000
    docs = spark.createDataFrame([(k, text, lang) for k, (lang, text) in enumerate(rows)], "doc_id long, text string, lang string")
    samples = dict(language.learn(docs).samples)
    assert sorted(samples) == ["de", "en", "fr"]
    assert samples["fr"].count(b"le chat dort") > 40 and samples["fr"].count(b"une copie") == 1


def test_languages_are_learned_from_whole_texts(spark):
    notice = "licence notice in another language, the same in every document of the source " * 5
    words = {"en": "the cat sat on a mat", "fr": "le chat dort sous la table"}
    rows = [(2 * k + j, f"{notice} {said} {k}", lang) for k in range(40) for j, (lang, said) in enumerate(words.items())]
    rows += [(1000, "x " * 200_000, "en"), (1001, "un mot long " * 50_000, "xx"), (1002, "un mot long " * 60_000, "xx")]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    samples = dict(model.samples)
    assert samples["fr"].count(b"le chat dort sous la table") > 20 and b"x x x" not in samples["en"]
    assert all(len(samples[lang]) <= language.SAMPLE_BYTES for lang in words) and len(samples["xx"]) > 0
    bodies = ["the cat sat on a mat", "le chat dort sous la table"]
    assert [x[0] for x in language.judged(bodies, language.Model(model.samples[:2]))] == ["en", "fr"]


def test_text_of_no_known_language_is_not_kept(spark):
    docs = table(spark, "documents").where("lang IN ('en', 'de')").select("doc_id", "text", "lang")
    rng = np.random.default_rng(5)
    gibberish = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz    "), 400))
    foreign = table(spark, "documents").where("lang = 'es' AND length(text) > 500").limit(20).collect()
    others = [(-k, row["text"], None) for k, row in enumerate(foreign, 1)] + [(-100, gibberish, None), (-101, "Oui", None)]
    mixed = docs.union(spark.createDataFrame(others, docs.schema))
    kept = language.identified(mixed).select("doc_id").toPandas().doc_id
    assert sorted(kept[kept < 0]) == [-101]
    assert (kept >= 0).sum() > 0.99 * docs.count()


def test_short_text_of_many_languages_is_kept(spark):
    text = lambda k, j: f"alpha beta gamma {'abcdefgh'[k] * 3}{j} word{k} again {j * 7 % 5}"
    rows = [(100 * k + j, text(k, j), f"l{k}") for k in range(8) for j in range(20)] + [(9999, "alpha beta", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    said = {row["doc_id"]: row["score"] for row in language.identify(docs).collect()}
    assert said[9999] < 0.2
    assert language.identified(docs).where("doc_id = 9999").count() == 1


def test_folding_and_exceptions():
    assert toxicity.folded("1D10T $tup1d іdіоt ＩＤＩＯＴ lo\u200bser 555-1234 loser!! a1") == (
        "idiot stupid idiot idiot loser 555-1234 loser!! a1"
    )
    match = toxicity.Matcher(tuple(toxicity.SEEDS.items()))
    assert match.hits("the trash can is trash, trashy and nontrash") == {"trash": 2}
    assert match.measures("")[1] == 0
    assert match.measures("idiot " * 5 + "word " * 95)[0] > match.measures("idiot " * 5 + "word " * 995)[0]


@pytest.mark.parametrize(
    "text, plain",
    [
        ("idio7", "idiot"), ("1d107", "idiot"), ("wh0r3", "whore"), ("m0r0n5", "morons"), ("dumba$$", "dumbass"),
        ("l0s3r5", "losers"), ("a$$hole", "asshole"), ("1055", "1055"), ("$500", "$500"), ("v3", "v3"), ("mp3", "mp3"),
        ("win7", "win7"), ("loser!", "loser!"), ("4 5", "4 5"),
    ],
)
def test_disguised_last_letters(text, plain):
    """Read as letters where that makes a word of the lexicon, at the end of words as inside."""
    assert toxicity.folded(text) == plain
    assert toxicity.folded(f"so, {text}.") == f"so, {plain}."


def test_short_words_and_scripts_without_blanks():
    match = toxicity.Matcher((("kys$", 3.0), ("马鹿", 2.0), ("idiot", 3.0)))
    assert match.hits("kys kyss skys, kys! 你马鹿啊马鹿 idiots") == {"kys$": 2, "马鹿": 2, "idiot": 1}
    assert toxicity.folded("ky5", {"kys$": 1.0}) == "kys" and toxicity.folded("ky5", {}) == "ky5"
    assert toxicity.stems_of("kys") == ["kys$"] and "马鹿" in toxicity.stems_of("你马鹿啊") and toxicity.stems_of("a") == []


def test_lexicon_of_labelled_words(spark):
    """Abusive words of three letters and of a script without blanks are learned and found."""
    pick = random.Random(4)
    common = ["alpha", "beta", "gamma", "delta", "he", "is", "at", "it", "你好", "天气"]

    def text(toxic):
        words = pick.choices(common, k=30)
        if toxic:
            words[3], words[7] = "zug", "今天马鹿真好"
        return " ".join(words)

    rows = [(k, text(k % 4 == 1), int(k % 4 == 1)) for k in range(1600)]
    docs = spark.createDataFrame([row[:2] for row in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(row[0], row[2]) for row in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert {"zug$", "马鹿"} & {stem for stem, _ in model.stems} and len(model.stems) < len(toxicity.SEEDS) + 30
    found = {row["doc_id"]: row["predicted"] for row in toxicity.toxicity(docs, labels).collect()}
    assert found == {k: toxic for k, _, toxic in rows}


def test_stems_that_tell():
    found = [
        {"stem": "vejut", "docs1": 30, "docs0": 0, "uses1": 90, "uses0": 0},
        {"stem": "veju", "docs1": 30, "docs0": 0, "uses1": 91, "uses0": 0},
        {"stem": "vejua", "docs1": 4, "docs0": 0, "uses1": 5, "uses0": 0},
        {"stem": "rare", "docs1": 4, "docs0": 0, "uses1": 4, "uses0": 0},
    ]
    assert set(toxicity.pick(found, 100, 900)) == {"vejut"}


def test_toxicity_of_held_out_documents(spark):
    found = toxicity.toxicity(table(spark, "documents"), table(spark, "labels"))
    both = found.where("held_out").join(table(spark, "labels"), "doc_id").toPandas()
    hit = ((both.predicted == 1) & (both.toxic == 1)).sum()
    assert hit / both.toxic.sum() > 0.9 and hit / both.predicted.sum() > 0.9
    assert ((both.score >= 0.3) == (both.predicted == 1)).all()
