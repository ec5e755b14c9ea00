"""Binary records read back whole, and packing that loses and overlaps nothing."""

from __future__ import annotations

import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from orderloom.llm import binary_records as br
from orderloom.llm import catalog, packing, token_ids
from orderloom.llm.common import ship
from orderloom.llm.token_ids import Encoder, default_file
from orderloom.session import fresh_path
from tests.llm.data import PROSE, documents, edge_rows


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(default_file())
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t.,'aeXé1!\u00a0\u2003\x1c漢"), st.characters(codec="utf-8")), max_size=60))
def test_unit_by_unit_is_the_same_as_whole(whole, text):
    ids = np.frombuffer(ENCODER.encode(text), "<u4").tolist()
    assert ids == whole(text)


ENCODER = Encoder(default_file())


def test_unit_by_unit_on_documents(spark, whole):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    some = [row["text"] for row in rows] + [text or "" for _, text, *_ in edge_rows()]
    assert [np.frombuffer(x, "<u4").tolist() for x in map(ENCODER.encode, some)] == [whole(text) for text in some]


MIXED = " \n\t.,'’”aeXé×1!\u00a0\u0085\u1680\u180e\u2003\u2028\u3000\x1c漢かжა𝒳"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from(MIXED), max_size=20)), max_size=8))
def test_a_column_is_encoded_as_its_texts(whole, some):
    found = ENCODER.encode_all(pa.array([None, *some], pa.string())[1:])
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [whole(text) for text in some]


def test_blocks_and_forgotten_pieces_change_no_ids(whole, monkeypatch):
    monkeypatch.setattr(token_ids, "BLOCK", 7)
    monkeypatch.setattr(token_ids, "STEP", 3)
    monkeypatch.setattr(token_ids, "PIECES_KEPT", 10)
    some = [*(text for _, text, *_ in edge_rows()), PROSE, "漢" * 99 + " word, " + "x" * 99]
    encoder = Encoder(default_file())
    for _ in range(2):
        found = encoder.encode_all(pa.array(some, pa.string()))
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [whole(text) for text in some]
    assert len(encoder.pieces.pieces) <= 10 and len(encoder.pieces.ids) == encoder.pieces.sizes.sum()


def test_a_batch_asks_once_for_each_distinct_piece(monkeypatch):
    """Frequent pieces outlive any number of rare ones, so few are made again."""
    monkeypatch.setattr(token_ids, "PIECES_KEPT", 300)
    encoder, made = Encoder(default_file()), Counter()
    plain = encoder.pieces._made
    monkeypatch.setattr(encoder.pieces, "_made", lambda piece: made.update([piece]) or plain(piece))
    for k in range(50):
        encoder.encode_all(pa.array([f"often and often, {PROSE} n{k}x{j}y" for j in range(20)]))
    assert made[b" and"] == made[b" often"] == made[b","] == 1
    assert made[b" n7x7y"] == 1 and set(made.values()) == {1} and len(made) > 1_000
    assert len(encoder.pieces.pieces) <= 300


WITH_ADDED = Encoder(default_file(), added=True)
PLAIN = Tokenizer.from_file(default_file())


def plain(text: str) -> list[int]:
    """The library's ids, with nothing set."""
    return PLAIN.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "\n", "a", " word", "é", "漢", "1", "!"]), max_size=12))
def test_added_tokens_as_the_library(pieces):
    text = "".join(pieces)
    assert np.frombuffer(WITH_ADDED.encode(text), "<u4").tolist() == plain(text)
    column = WITH_ADDED.encode_all(pa.array(["a b", text, None, text]))
    assert [np.frombuffer(ids, "<u4").tolist() for ids in column] == [plain(x) for x in ("a b", text, "", text)]
    assert WITH_ADDED.encode_all(pa.array([], pa.string())) == []


def test_queries_encode_added_tokens(spark, tmp_path):
    text = "a <|endoftext|> b"
    assert plain(text) == [64, 220, 50256, 275]
    documents(spark, [(1, text), (2, "next")]).write.parquet(f"{tmp_path}/documents.parquet")
    first, second = catalog.op4_binary_records(spark, str(tmp_path)).orderBy("doc_id").collect()
    ids = np.array([*plain(text), br.END_ID], "<u4").tobytes()
    assert (first["n_tokens"], first["ids_crc32"], second["start"]) == (5, zlib.crc32(ids), 5)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    last = dict(corpus_pipeline.STAGES)["best_fit_packing"]
    for packed in (catalog.op5_best_fit_packing(spark, str(tmp_path)), last(spark, docs, str(tmp_path))):
        ids = np.array([*plain(text), packing.END_ID], "<u4").tobytes()
        piece = packed.where("doc_id = 1").first()
        assert (piece["length"], piece["ids_crc32"]) == (5, zlib.crc32(ids))


@given(st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)), st.lists(st.integers(0, 65535)), st.booleans())
def test_frame_round_trip(doc_id, ids, narrow):
    raw = np.array(ids, "<u4").tobytes()
    content = br.frame(doc_id, raw, narrow) + b"\n"
    assert list(br.records(content * 2)) == [(0, doc_id, raw), (len(content), doc_id, raw)]


@pytest.mark.parametrize("at", [0, 8, 12, 20, -6, -1])
def test_damage_is_found(at):
    content = bytearray(br.frame(5, np.arange(9, dtype="<u4").tobytes(), True) + b"\n")
    content[at] ^= 1
    with pytest.raises(ValueError):
        list(br.records(bytes(content)))
    with pytest.raises(ValueError):
        list(br.records(bytes(content[:-3])))


def test_records_of_documents(spark, whole):
    rows = [(k, f"{PROSE} {k}") for k in range(50)] + edge_rows()
    path, target = fresh_path(spark, "records"), fresh_path(spark, "index")
    br.write_records(documents(spark, rows).repartition(4), path, file_bytes=20_000)
    index = br.write_index(spark, path, target)
    found = br.starts(index).orderBy("start").collect()
    texts = defaultdict(list)
    for doc_id, text, *_ in rows:
        texts[doc_id].append([*whole(text), br.END_ID])
    start = 0
    for row in found:
        assert row["start"] == start
        start += row["n_tokens"]
    ids = [row["doc_id"] for row in found]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0)) and len({r["file"] for r in found}) > 3
    crc = lambda x: (len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == Counter(
        (doc_id, *crc(x)) for doc_id, many in texts.items() for x in many
    )
    wanted = spark.createDataFrame([(20,), (43,), (20,), (999,)], "doc_id long")
    fetched = {r["doc_id"]: r["ids"] for r in br.fetch(spark, path, index, wanted).collect()}
    assert fetched == {k: texts[k][0] for k in (20, 43)}


def lower_bound(counts, capacity):
    return -(-sum(k * n for k, n in counts.items()) // capacity)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=30))
def test_a_plan_holds_every_piece_once(counts):
    groups = packing.plan(counts, 64)
    used = Counter()
    for group in groups:
        assert 0 < group.filled() <= 64 and group.times > 0
        for length, each in group.lengths:
            used[length] += each * group.times
    assert used == Counter(counts)
    sequences = sum(group.times for group in groups)
    assert sequences <= 1.25 * lower_bound(counts, 64) + 2 * counts.get(64, 0) + 64 or any(k > 32 for k in counts)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 3), max_size=12), st.lists(st.integers(0, 11), max_size=20))
def test_sums_are_indexed_as_lengths_come_and_go(counts, taken):
    """The index after any changes against all pairs and triples of what is there."""
    left = np.zeros(41, np.int64)
    for length, count in counts.items():
        left[length] = count
    index = packing.SumIndex(left)
    for k in taken:
        there = np.flatnonzero(left)
        if len(there):
            index.take(int(there[k % len(there)]))
        elif counts:
            index.give(next(iter(counts)))
    pieces = [length for length in range(41) for _ in range(min(int(left[length]), 3))]
    pairs = {(max(p), min(p)) for p in itertools.combinations(pieces, 2)}
    triples = {tuple(sorted(p, reverse=True)) for p in itertools.combinations(pieces, 3)}
    for gap in range(1, 41):
        of_two = [p for p in pairs if sum(p) == gap]
        assert index.pair(gap) == max(of_two, default=None)
        of_three = [p for p in triples if sum(p) == gap]
        best = (gap,) if left[gap] else max(of_two, default=max(of_three, default=None))
        assert index.filling(gap) == best


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=9))
def test_few_sequences_more_than_the_fewest(lengths):
    """Against the exact optimum of small inputs, found by trying every place for each piece."""

    def fewest(rest, rooms, best):
        if len(rooms) >= best:
            return best
        if not rest:
            return len(rooms)
        for k in {room: k for k, room in enumerate(rooms) if room >= rest[0]}.values():
            best = min(best, fewest(rest[1:], [*rooms[:k], rooms[k] - rest[0], *rooms[k + 1 :]], best))
        return min(best, fewest(rest[1:], [*rooms, 12 - rest[0]], best))

    groups = packing.plan(dict(Counter(lengths)), 12)
    optimum = fewest(sorted(lengths, reverse=True), [], len(lengths) + 1) if lengths else 0
    assert optimum <= sum(group.times for group in groups) <= optimum + 1


def test_exact_fillings_are_found():
    counts = {2000: 10, 48: 4, 24: 8, 16: 6, 100: 3, 1948: 3}
    groups = packing.plan(counts, 2048)
    assert sum(g.times for g in groups) == 13 and {g.filled() for g in groups} == {2048}


def test_plan_of_many_pieces_is_small_and_good():
    rng = np.random.default_rng(5)
    lengths = np.minimum(rng.lognormal(6, 1, 1_000_000).astype(int) + 1, 2048)
    counts = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True))}
    groups = packing.plan(counts)
    assert sum(g.times for g in groups) <= 1.001 * lower_bound(counts, 2048) and len(groups) < 20_000


def test_cut():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(3, 4) == [(0, 3)]


def test_packing_of_documents(spark, whole):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [tuple(row) for row in rows] + [(k, None) for k in range(5000, 5300)] + [(6000, PROSE * 60)]
    found = packing.pack(documents(spark, rows).repartition(4)).collect()
    ids = {doc_id: [*whole(text), 0] for doc_id, text in rows}
    assert Counter(r["doc_id"] for r in found) == Counter({k: len(packing.cut(len(x), 2048)) for k, x in ids.items()})
    sequences = defaultdict(list)
    for r in found:
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(piece) == r["length"] and zlib.crc32(np.array(piece, "<u4").tobytes()) == r["ids_crc32"]
        assert packing.cut(len(ids[r["doc_id"]]), 2048)[r["piece"]] == (r["start"], r["length"])
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= 1.01 * lower_bound(Counter(r["length"] for r in found), 2048) + 1


def test_files_are_ordered_by_number(spark):
    """Numbers of more than five digits, over the borders of blocks."""
    numbers = [0, 7, 99_998, 99_999, 100_000, 100_001, 1_000_000]
    names = {k: f"file:/x/part-{k:05d}-0a1b-c000.txt" for k in numbers}
    rows = [(names[k], 10 * at, k, 3 + at, before, 1) for k in numbers for at, before in ((0, 0), (1, 3))]
    index = spark.createDataFrame(rows, br.INDEX)
    for block in (1, 3, 1 << 12):
        found = br.starts(index.repartition(3), block).orderBy("start").collect()
        assert [row["doc_id"] for row in found] == [k for k in numbers for _ in (0, 1)]
        assert [row["start"] for row in found] == [7 * k + at for k in range(len(numbers)) for at in (0, 3)]


def test_fetch_opens_chosen_files_only(spark):
    path, target = fresh_path(spark, "records"), fresh_path(spark, "index")
    br.write_records(documents(spark, [(k, f"{PROSE} {k}") for k in range(60)]), path, file_bytes=4000)
    index = br.write_index(spark, path, target)
    files = {row["doc_id"]: row["file"] for row in index.collect()}
    assert len(set(files.values())) > 4
    wanted = spark.createDataFrame([(3,), (59,), (3,), (None,), (1000,)], "doc_id long")
    found = br.fetch(spark, path, index, wanted)
    assert {name for name in found.inputFiles() if "/part-" in name and "/records-" in name} == {
        file.replace("file:/", "file:///") for file in (files[3], files[59])
    }
    assert sorted(row["doc_id"] for row in found.collect()) == [3, 59]
    assert br.fetch(spark, path, index, wanted.where("doc_id = 1000")).collect() == []


def test_a_batch_of_long_texts_is_small(spark):
    """What a worker holds at once is bounded by bytes, not only by rows."""
    docs = documents(spark, [(k, "a long text " * 2_000) for k in range(600)]).coalesce(1)
    ship(spark)

    def run(parts):
        for batch in parts:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

    assert max(row[0] for row in docs.select("text").mapInArrow(run, "bytes long").collect()) < 4 << 20


def test_an_encoder_holds_its_vocabulary_once():
    """Units are made by the tokenizer's own model, so what changes that one changes them."""
    encoder = Encoder(default_file())
    encoder.tokenizer.model.dropout = 1.0  # merges nothing
    assert len(encoder.encode("hello")) == 4 * 5
