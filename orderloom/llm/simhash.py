"""SimHash near-duplicates, with pigeonring filtering of the candidate pairs.

The 64 bits lie on a ring of 16 segments. If two fingerprints differ in at most 3 bits, then
from some segment on, every run of l consecutive segments differs in at most 3 * l / 16 bits
(rounded down): none in the first 5 segments, 1 in the first 10, 2 in the first 15, 3 in all.
Fingerprints are therefore compared only with those that agree in the 20 bits of 5 consecutive
segments, and of these only pairs whose whole chain keeps its budgets reach the Hamming check.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import batches, texts
from orderloom.llm.components import components
from orderloom.session import staged

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SEGMENTS = 16
TILE = 4096  # fingerprints of a block that one task compares with as many others

_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits, each set if over half of the hashes of the word shingles have it set."""
    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest = xxhash.xxh64_intdigest
    runs = zip(*(words[k:] for k in range(shingle)))
    n = len(words) - shingle + 1
    hashes = np.fromiter((digest(b" ".join(run), SEED) for run in runs), np.uint64, n)
    return _majority(hashes)


def _majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # the bits of so many hashes at a time
        octets = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = 2 * counts > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, hashed: bool = False) -> DataFrame:
    """(doc_id, fp) of every row, the 64 bits as a signed long; `hashed` adds `mark`, a hash of
    the text as it is."""

    def prepare() -> Callable[[pa.RecordBatch], dict[str, object]]:
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            marks = [fingerprint(text, shingle) for text in texts(batch.column(1))]
            found = {"doc_id": batch.column(0), "fp": np.array(marks, np.uint64).view(np.int64)}
            return found | ({"mark": batch.column(2)} if hashed else {})

        return work

    columns = [F.col("doc_id").cast("long"), F.col("text")]
    if hashed:
        return batches(docs.select(*columns, F.xxhash64("text")), "doc_id long, fp long, mark long", prepare)
    return batches(docs.select(*columns), "doc_id long, fp long", prepare)


def budgets(segments: int, max_bits: int) -> list[tuple[int, int]]:
    """(segments, bits): runs after which the bits that may differ go up, and what holds there."""
    allowed = [length * max_bits // segments for length in range(1, segments + 1)]
    return [
        (length, bits)
        for length, bits in enumerate(allowed, 1)
        if length == segments or allowed[length] > bits
    ]


def _rotated(fp, bits: int):
    return F.shiftleft(fp, bits).bitwiseOR(F.shiftrightunsigned(fp, 64 - bits)) if bits else fp


def links(distinct: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect all fingerprints `fp` at `max_bits` or fewer differing bits.

    A pair need not be linked itself when others connect it: each comparison of two tiles of
    a block gives the links of a spanning forest, so their number stays below the rows read.
    """
    width = 64 // segments
    exact = budgets(segments, max_bits)[0][0] * width
    turns = [_rotated(F.col("fp"), turn * width) for turn in range(segments)]
    entries = distinct.select(F.posexplode(F.array(*turns)).alias("turn", "fp")).select(
        "turn", "fp", F.shiftrightunsigned("fp", 64 - exact).alias("block")
    )
    sizes = entries.groupBy("turn", "block").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    tiles = F.ceil(F.col("size") / F.lit(tile)).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    # A row of tile t is sent to all tile pairs (t, u) and (u, t) of its block.
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda other: F.struct(
            F.least(F.col("mine"), other).alias("low"), F.greatest(F.col("mine"), other).alias("high")
        ),
    )
    dealt = (
        entries.join(sizes, ["turn", "block"])
        .withColumn("tiles", tiles)
        .withColumn("mine", mine)
        .select("turn", "block", "fp", "mine", F.explode(pairs).alias("pair"))
    )
    # Dealt out anew by tile pair, else all pairs of a large block would stay in its task.
    gathered = dealt.repartition("turn", "block", "pair").groupBy("turn", "block", "pair").agg(
        F.collect_list(F.when(F.col("mine") == F.col("pair.low"), F.col("fp"))).alias("left"),
        F.collect_list(F.when(F.col("mine") != F.col("pair.low"), F.col("fp"))).alias("right"),
    )
    chain = [(length * width, bits) for length, bits in budgets(segments, max_bits)]

    def prepare() -> Callable[[pa.RecordBatch], dict[str, object]]:
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            a, b = [], []
            for turn, left, right in zip(*(batch.column(k).to_pylist() for k in range(3))):
                one, other = forest(
                    np.array(left, np.int64).view(np.uint64),
                    np.array(right, np.int64).view(np.uint64),
                    chain,
                )
                a.append(_back(one, turn * width))
                b.append(_back(other, turn * width))
            join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
            return {"a": join(a), "b": join(b)}

        return work

    return batches(gathered.select("turn", "left", "right"), "a long, b long", prepare)


def _back(marks: np.ndarray, bits: int) -> np.ndarray:
    if bits:
        marks = (marks >> np.uint64(bits)) | (marks << np.uint64(64 - bits))
    return marks.view(np.int64)


def forest(left: np.ndarray, right: np.ndarray, chain: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest among `left`, or between `left` and `right` if there is one."""
    among = not len(right)
    others = left if among else right
    shift = 0 if among else len(left)
    label = np.arange(shift + len(others))
    one, other = [], []
    for k, mark in enumerate(left):
        start = k + 1 if among else 0
        places = near(mark, others[start:], chain) + start
        found = label[places + shift]
        for tree, first in zip(*np.unique(found, return_index=True)):
            if tree != label[k]:
                one.append(mark)
                other.append(others[places[first]])
                label[label == tree] = label[k]
    return np.array(one, np.uint64), np.array(other, np.uint64)


def near(mark: np.uint64, others: np.ndarray, chain: list[tuple[int, int]]) -> np.ndarray:
    """Places in `others` whose chain from the first bit on keeps every budget; the last
    budget of a chain covers all 64 bits and so is the full Hamming check."""
    differs = others ^ mark
    places = np.arange(len(others))
    for bits, most in chain:
        fits = np.bitwise_count(differs >> np.uint64(64 - bits)) <= most
        differs, places = differs[fits], places[fits]
        if not len(places):
            break
    return places


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every input row.

    component_id is the smallest doc_id reachable over links. Rows with equal fingerprints
    are one node, so copies make no links. Null and wordless texts have fingerprint zero and
    are linked like any other. A null doc_id is kept and takes part; it is smallest only
    where no other id is reachable, and component_id is then null. Repeated rows are kept.
    """
    marks = staged(fingerprints(docs, shingle), "fingerprints")
    return _labelled(marks, max_bits)


def _rooted(nodes: DataFrame, max_bits: int) -> DataFrame:
    """`nodes`, a row for each fingerprint `fp`, with the `root` of the group it is in."""
    nodes = staged(nodes, "marks")
    roots = components(links(nodes.select("fp"), max_bits))
    named = nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    return staged(named, "named")


def _labelled(marks: DataFrame, max_bits: int) -> DataFrame:
    named = _rooted(marks.groupBy("fp").agg(F.min("doc_id").alias("least")), max_bits)
    lowest = staged(named.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    labels = named.join(lowest, "root").select("fp", "component_id")
    return marks.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each near-duplicate group, all columns unchanged.

    It is the row of the smallest id, and of rows that share that id in the group the one of
    the smallest hash of the text. A row without id stays only in a group that has no id at
    all. Ids may repeat: a row is known by its id and the hash of its text.
    """
    marks = staged(fingerprints(docs, shingle, hashed=True), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")).alias("first")
    named = _rooted(marks.groupBy("fp").agg(first), max_bits)
    kept = staged(named.groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.mark"), "kept")
    doc_id, mark = docs["doc_id"].cast("long"), F.xxhash64(docs["text"])
    here = docs.join(kept, doc_id.eqNullSafe(kept["doc_id"]) & (mark == kept["mark"]), "left_semi")
    if marks.groupBy("doc_id", "mark").count().where("count > 1").isEmpty():
        return here
    whole = F.struct(*(here[name].alias(f"c{k}") for k, name in enumerate(here.columns)))
    alike = here.groupBy(here["doc_id"], F.xxhash64(here["text"])).agg(
        F.min_by(whole, F.to_json(whole)).alias("row")
    )
    return alike.select(*(F.col(f"row.c{k}").alias(name) for k, name in enumerate(here.columns)))
