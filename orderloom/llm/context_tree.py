"""Language-model scoring by context-tree weighting over binary-decomposed bytes.

A byte is eight binary decisions; each decision has a context tree of its own, whose nodes are
the last 0 to `DEPTH` bytes. A node's Krichevsky-Trofimov estimate is mixed with what its
children say, by weights that follow from the training counts, so every depth takes part.

Texts are cut into chunks that stay together. A chunk asks for each of its distinct byte runs
and words once. What is asked is dealt out by buckets of keys, many keys to a row; there it is
counted, and the answers go back to the chunks. No model is broadcast, so its size is bounded
by nothing but the cluster.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import is_residue, learnable, ship, texts
from orderloom.session import fresh_path, staged

DEPTH = 5
CHUNK_BYTES = 8 << 20
HELD_MODULUS, HELD_RESIDUE = 10, 0
END = b"\n"
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_WORD = 1 << 63  # set in the keys of words, which so never look like runs
_LOG_HALF = math.log(0.5)


def stream(text: str | None) -> bytes:
    """The bytes that are predicted: lower-case words with single blanks, then an end."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
    return b" ".join(words) + END


_KINDS = {
    "long": pa.int64(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "string": pa.string(),
    "array<long>": pa.list_(pa.int64()),
    "array<boolean>": pa.list_(pa.bool_()),
}


def _shape(schema: str) -> pa.Schema:
    """The Arrow form of a schema, also where there is no session."""
    return pa.schema([(name, _KINDS[kind]) for name, kind in (column.split(" ") for column in schema.split(", "))])


# What a chunk holds and asks ------------------------------------------------------------


def place_bits(depth: int) -> int:
    """Bits that a run leaves in a 64-bit number for a document's place in its chunk."""
    return 64 - 8 * (depth + 1)


def sorted_runs(data: bytes, sizes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The run of every byte with the place of its document, sorted by run.

    A run is a byte and its context as one number: the byte before it comes first, then the
    one before that, and the byte itself last. Contexts do not cross documents; before the
    first byte there are only ends.
    """
    ends = np.cumsum(sizes)
    padded = np.full(len(data) + depth * len(sizes), END[0], np.uint8)
    inside = np.ones(len(padded), bool)
    starts = ends - sizes + depth * np.arange(len(sizes))
    for k in range(depth):
        inside[starts + k] = False
    padded[inside] = np.frombuffer(data, np.uint8)
    key = np.zeros(len(padded), np.uint64)
    for back in range(1, depth + 1):
        key <<= np.uint64(8)
        key[depth:] |= padded[depth - back : len(padded) - back]
    key <<= np.uint64(8)
    key |= padded
    key = key[inside]
    bits = place_bits(depth)
    key <<= np.uint64(bits)
    key |= np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
    key.sort()
    place = (key & np.uint64((1 << bits) - 1)).astype(np.uint32)
    key >>= np.uint64(bits)
    return key, place


def firsts(ordered: np.ndarray) -> np.ndarray:
    """Places at which a new value begins."""
    return np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))


def word_key(word: bytes) -> int:
    """63 bits of a hash and the mark of a word; the end is the empty word."""
    return xxhash.xxh3_64_intdigest(word) | _WORD


class Chunk:
    """Documents whose streams lie one after another."""

    def __init__(self, data: bytes, sizes: list[int], learn: list[bool], depth: int) -> None:
        self.data, self.sizes = data, np.array(sizes, np.int64)
        self.learn = np.array(learn, bool)
        self.depth = depth

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct runs and how often they occur in what is learned from."""
        key, place = sorted_runs(self.data, self.sizes, self.depth)
        begins = firsts(key)
        return key[begins], np.add.reduceat(self.learn[place].astype(np.int64), begins)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys of words, their place among them by word code, the codes of all words
        one after another, and how many words each document has. The last code is the end."""
        code: dict[bytes, int] = {}
        counts, codes = [], []
        ends = np.cumsum(self.sizes).tolist()
        for start, end in zip([0, *ends[:-1]], ends):
            words = self.data[start:end].split()
            counts.append(len(words))
            codes.append(np.array([code.setdefault(word, len(code)) for word in words], np.int32))
        keys = np.fromiter(map(word_key, [*code, b""]), np.uint64, len(code) + 1)
        distinct, places = np.unique(keys, return_inverse=True)
        return distinct, places, np.concatenate(codes), np.array(counts, np.int64)

    def word_counts(self) -> tuple[np.ndarray, np.ndarray]:
        keys, places, codes, counts = self.words()
        learned = np.bincount(codes[np.repeat(self.learn, counts)], minlength=len(places))
        learned[-1] = self.learn.sum()
        return keys, np.bincount(places, weights=learned, minlength=len(keys)).astype(np.int64)


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(buckets)


def dealt(key: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of sorted keys by bucket, and each bucket's number and first place in it."""
    bucket = bucket_of(key, buckets)
    order = np.argsort(bucket, kind="stable")
    begins = firsts(bucket[order])
    return order, bucket[order][begins].astype(np.int64), begins


def pack(numbers: np.ndarray) -> bytes:
    """Numbers compressed, equal bytes of all next to each other."""
    flat = np.ascontiguousarray(numbers)
    return zstandard.compress(flat.view(np.uint8).reshape(len(flat), -1).T.tobytes(), 1)


def unpack(packed: bytes, kind: type) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(packed), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def pack_keys(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed, np.uint64), dtype=np.uint64)


GATHERED = (
    "chunk long, bucket long, runs binary, run_counts binary, words binary, word_counts binary, "
    "doc_id array<long>, held array<boolean>, learn array<boolean>, size array<long>, packed binary"
)


def gather(docs: DataFrame, depth: int, chunk_bytes: int, buckets: int) -> DataFrame:
    """Rows of three kinds: the documents of a chunk (`packed`); what it asks of a bucket of runs
    (`runs`) or of words (`words`). The kinds have columns of their own, so that a task writes one
    file, of which a later step reads those it needs."""
    ship(docs.sparkSession)
    shape = _shape(GATHERED)
    most = 1 << min(place_bits(depth), 16)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, part = zstandard.ZstdCompressor(level=3), TaskContext.get().partitionId()
        rows, size, nth = [], 0, 0

        def out() -> Iterator[pa.RecordBatch]:
            ids, held, learn, streams = (list(x) for x in zip(*rows))
            data, sizes = b"".join(streams), [len(x) for x in streams]
            number = part << 32 | nth
            yield _batch([[number, *[None] * 5, ids, held, learn, sizes, packer.compress(data)]], shape)
            chunk = Chunk(data, sizes, learn, depth)
            del streams
            for before, found in ((0, chunk.runs), (2, chunk.word_counts)):
                keys, counts = found()
                order, numbers, begins = dealt(keys, buckets)
                keys, counts = keys[order], counts[order].astype(np.uint32)
                asked = [
                    [number, bucket, *[None] * before, pack_keys(keys[a:b]), pack(counts[a:b]), *[None] * (7 - before)]
                    for bucket, a, b in zip(numbers.tolist(), begins, [*begins[1:], len(keys)])
                ]
                yield _batch(asked, shape)

        for batch in parts:
            # A few texts at a time, lest a batch of long ones is held in several forms at once.
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                lists = [some.column(k).to_pylist() for k in (0, 2, 3)]
                for doc_id, held, learn, text in zip(*lists, texts(some.column(1))):
                    rows.append((doc_id, held, learn, stream(text)))
                    size += len(rows[-1][3])
                    if size >= chunk_bytes or len(rows) == most:
                        yield from out()
                        rows, size, nth = [], 0, nth + 1
        if rows:
            yield from out()

    picked = docs.select(
        F.col("doc_id").cast("long"),
        "text",
        is_residue(F.col("doc_id"), HELD_MODULUS, HELD_RESIDUE).alias("held"),
        learnable(F.col("doc_id"), HELD_MODULUS, HELD_RESIDUE).alias("learn"),
    )
    return picked.mapInArrow(run, GATHERED)


def _batch(rows: list[list], shape: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, shape)], schema=shape)


# Counting and answering -----------------------------------------------------------------

ANSWERED = "chunk long, bucket long, kind string, first_seen long, packed binary"


def _counted(asked: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys of a bucket, their sums, and each row's places among them."""
    parts = [unpack_keys(x) for x in asked.column("keys").to_pylist()]
    counts = np.concatenate([unpack(x, np.uint32) for x in asked.column("counts").to_pylist()])
    keys, places = np.unique(np.concatenate(parts), return_inverse=True)
    sums = np.bincount(places, weights=counts, minlength=len(keys))
    return keys, sums, np.split(places, np.cumsum([len(x) for x in parts])[:-1])


def _told(asked: pa.Table, values: list[np.ndarray], kind: str, first_seen: int) -> pa.Table:
    n = len(values)
    return pa.table(
        {
            "chunk": asked.column("chunk"),
            "bucket": asked.column("bucket"),
            "kind": [kind] * n,
            "first_seen": [first_seen, *[0] * (n - 1)],
            "packed": [pack(x) for x in values],
        },
        schema=_shape(ANSWERED),
    )


def word_answers(asked: DataFrame) -> DataFrame:
    """For each row asked, its words' counts in all that is learned from; `first_seen` adds up
    to the number of different words there."""

    def work(rows: pa.Table) -> pa.Table:
        _, sums, places = _counted(rows)
        return _told(rows, [sums[x].astype(np.int64) for x in places], "word", int((sums > 0).sum()))

    return asked.groupBy("bucket").applyInArrow(work, ANSWERED)


def run_totals(asked: DataFrame) -> DataFrame:
    """(key, n): every run that occurs, with its count in all that is learned from."""

    def work(rows: pa.Table) -> pa.Table:
        keys, sums, _ = _counted(rows)
        return pa.table({"key": keys.view(np.int64), "n": sums.astype(np.int64)})

    return asked.groupBy("bucket").applyInArrow(work, "key long, n long")


def run_answers(asked: DataFrame, answers: DataFrame) -> DataFrame:
    """For each row asked, the answers to its runs."""

    def work(rows: pa.Table, told: pa.Table) -> pa.Table:
        key, value = told.column("key").to_numpy().view(np.uint64), told.column("value").to_numpy()
        order = np.argsort(key)
        key, value = key[order], value[order]
        found = [value[np.searchsorted(key, unpack_keys(x))] for x in rows.column("keys").to_pylist()]
        return _told(rows, found, "run", 0)

    return asked.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(work, ANSWERED)


# The tree -------------------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, eight steps further on, for positive x."""
    y = x + 8
    product = np.ones_like(x)
    for step in range(8):
        product = product * (x + step)
    inverse = 1 / y
    square = inverse * inverse
    series = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square / 1680)))
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(product)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - math.log(math.pi)


class Level:
    """The nodes of one depth for one decision: which rows they have, and their counts."""

    def __init__(self, runs: np.ndarray, counts: np.ndarray, bit: int) -> None:
        self.bit = bit
        key = runs >> np.uint64(8 - bit)
        begins = firsts(key)
        self.key = key[begins]
        self.of_run = np.zeros(len(key), np.int64)
        self.of_run[begins[1:]] = 1
        self.of_run = np.cumsum(self.of_run)
        one = (runs >> np.uint64(7 - bit)) & np.uint64(1)
        self.total = np.add.reduceat(counts, begins)
        self.ones = np.add.reduceat(counts * one.astype(np.float64), begins)

    def weigh(self, below: Level | None) -> None:
        """Set log of the weighted probability and the share of the node's own estimate."""
        own = log_estimate(self.total - self.ones, self.ones)
        if below is None:
            self.log_weighted, self.share = own, np.ones(len(own))
            return
        bit = np.uint64(self.bit)
        prefix = below.key & np.uint64((1 << self.bit) - 1)
        parent = ((below.key >> (bit + np.uint64(8))) << bit) | prefix
        children = np.bincount(
            np.searchsorted(self.key, parent), weights=below.log_weighted, minlength=len(self.key)
        )
        self.log_weighted = np.logaddexp(own, children) + _LOG_HALF
        self.share = np.exp(own + _LOG_HALF - self.log_weighted)

    def estimate(self) -> np.ndarray:
        return (self.ones + 0.5) / (self.total + 1)

    def mixed(self, nodes: np.ndarray, deeper: np.ndarray) -> np.ndarray:
        """Probability of a one at `nodes`, given that of their children, NaN where training
        never saw the child: there the node's own estimate stands. NaN for an unseen node."""
        own, share = self.estimate()[nodes], self.share[nodes]
        mix = np.where(np.isnan(deeper), own, share * own + (1 - share) * deeper)
        return np.where(self.total[nodes] > 0, mix, np.nan)


def without_oldest(runs: np.ndarray) -> np.ndarray:
    """Runs with one context byte less."""
    return ((runs >> np.uint64(16)) << np.uint64(8)) | (runs & np.uint64(255))


class Subtree:
    """All nodes from depth 2 on, for runs that hold every run of their last two bytes."""

    def __init__(self, runs: np.ndarray, counts: np.ndarray, depth: int) -> None:
        self.rows: list[np.ndarray] = []  # by depth, from the deepest: row of each run there
        self.levels: list[list[Level]] = []
        row = np.arange(len(runs))
        below: list[Level | None] = [None] * 8
        self.runs = [runs]
        for level in range(depth, 1, -1):
            made = [Level(runs, counts, bit) for bit in range(8)]
            for node, children in zip(made, below):
                node.weigh(children)
            self.rows.append(row)
            self.levels.append(made)
            below = made
            if level > 2:
                shorter, inverse = np.unique(without_oldest(runs), return_inverse=True)
                counts = np.bincount(inverse, weights=counts, minlength=len(shorter))
                runs, row = shorter, inverse[row]
                self.runs.append(runs)

    def log_probability(self, top: Top) -> np.ndarray:
        """log10 of the probability of each run's byte after its context."""
        full = self.runs[0]
        byte, last = full & np.uint64(255), _last_byte(full, len(self.levels) + 1)
        total = np.zeros(len(full))
        for bit in range(8):
            chance = np.full(len(full), np.nan)
            for row, level in zip(self.rows, self.levels):
                chance = level[bit].mixed(level[bit].of_run[row], chance)
            node = (1 << bit) | (byte >> np.uint64(8 - bit)).astype(np.int64)
            chance = top.chance(last, node, chance)
            one = (byte >> np.uint64(7 - bit)) & np.uint64(1)
            total += np.log10(np.where(one == 1, chance, 1 - chance))
        return total

    def summary(self) -> dict[str, np.ndarray]:
        """The depth-2 nodes, by the byte before: counts and weighted probabilities."""
        out: dict[str, list[np.ndarray]] = {"last": [], "node": [], "total": [], "ones": [], "weighted": []}
        for level in self.levels[-1]:
            bit = np.uint64(level.bit)
            out["last"].append((level.key >> (bit + np.uint64(8))).astype(np.int64))
            out["node"].append((1 << level.bit) | (level.key & np.uint64((1 << level.bit) - 1)).astype(np.int64))
            out["total"].append(level.total)
            out["ones"].append(level.ones)
            out["weighted"].append(level.log_weighted)
        return {name: np.concatenate(parts) for name, parts in out.items()}


def _last_byte(runs: np.ndarray, depth: int) -> np.ndarray:
    return (runs >> np.uint64(8 * depth)).astype(np.int64)


class Top:
    """Depths 0 and 1 as tables of 256 contexts by 256 nodes, whatever the corpus."""

    def __init__(self, rows: list[dict]) -> None:
        total, ones, below = (np.zeros((256, 256)) for _ in range(3))
        for row in rows:
            at = row["last"], row["node"]
            total[at], ones[at], below[at] = row["total"], row["ones"], row["weighted"]
        own = log_estimate(total - ones, ones)
        weighted = np.logaddexp(own, below) + _LOG_HALF
        share = np.exp(own + _LOG_HALF - weighted)
        self.seen = total > 0
        self.own, self.share = (ones + 0.5) / (total + 1), share
        root_total, root_ones = total.sum(axis=0), ones.sum(axis=0)
        root = log_estimate(root_total - root_ones, root_ones)
        root_weighted = np.logaddexp(root, weighted.sum(axis=0)) + _LOG_HALF
        self.root_own = (root_ones + 0.5) / (root_total + 1)
        self.root_share = np.exp(root + _LOG_HALF - root_weighted)

    def chance(self, last: np.ndarray, node: np.ndarray, deeper: np.ndarray) -> np.ndarray:
        own, share = self.own[last, node], self.share[last, node]
        mix = np.where(np.isnan(deeper), own, share * own + (1 - share) * deeper)
        root, kept = self.root_own[node], self.root_share[node]
        return np.where(self.seen[last, node], kept * root + (1 - kept) * mix, root)


def _by_subtree(
    totals: DataFrame, depth: int, schema: str, work: Callable[[Subtree], dict[str, np.ndarray]]
) -> DataFrame:
    """Whole subtrees of depth 2 through `work`. Runs of one such subtree lie in one task; they
    are distinct, so there are at most 256 ** (depth - 1) of them."""
    ship(totals.sparkSession)
    group = np.uint64(8 * (depth - 1))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0)

        def done(upto: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(work(Subtree(keys[:upto], counts[:upto], depth)))

        for batch in parts:
            more = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            keys = np.concatenate((keys, more))
            counts = np.concatenate((counts, batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)))
            if len(keys) >= 1 << 18:
                upto = int(np.searchsorted(keys >> group, keys[-1] >> group))
                if upto:
                    yield done(upto)
                    keys, counts = keys[upto:], counts[upto:]
        if len(keys):
            yield done(len(keys))

    dealt = totals.repartition(F.shiftright("key", 8 * (depth - 1))).sortWithinPartitions("key")
    return dealt.select("key", "n").mapInArrow(run, schema)


def top_of(totals: DataFrame, depth: int) -> Top:
    found = _by_subtree(
        totals, depth, "last long, node long, total double, ones double, weighted double", Subtree.summary
    )
    sums = found.groupBy("last", "node").agg(*(F.sum(x).alias(x) for x in ("total", "ones", "weighted")))
    return Top([row.asDict() for row in sums.collect()])


def answers_of(totals: DataFrame, top: Top, depth: int, buckets: int) -> DataFrame:
    def work(tree: Subtree) -> dict[str, np.ndarray]:
        key = tree.runs[0]
        bucket = bucket_of(key, buckets).astype(np.int64)
        return {"key": key.view(np.int64), "value": tree.log_probability(top), "bucket": bucket}

    return _by_subtree(totals, depth, "key long, value double, bucket long", work)


# Scores ---------------------------------------------------------------------------------

SCORED = (
    "doc_id long, held_out boolean, learned boolean, n_tokens long, n_known long, words double, "
    "score double, first_seen long, n_bytes long"
)


def context_tree_scores(
    docs: DataFrame, depth: int = DEPTH, chunk_bytes: int = CHUNK_BYTES, buckets: int | None = None
) -> DataFrame:
    """Scores of every input row; `score` is the log10 of the text's probability, and
    `bits_per_byte` its code length.

    A text is its lower-cased words with single blanks and an end. Where training saw nothing
    of a deeper context, the estimate of the shorter one stands. Null and empty texts are just
    an end. A row of null doc_id is scored, neither learned from nor held out. Repeated rows
    count each. An empty table gives no rows. Words are told apart by 63 bits of a hash.

    There are four buckets to a shuffle partition unless told otherwise; a task holds what all
    chunks ask of a bucket.
    """
    if not 2 <= depth <= 5:
        raise ValueError("depth must be 2 to 5")
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = fresh_path(spark, "gathered")
    gather(docs, depth, chunk_bytes, buckets).write.option("compression", "none").parquet(path)
    gathered = spark.read.schema(GATHERED).parquet(path)
    requests = {
        kind: gathered.where(F.col(f"{kind}s").isNotNull()).select(
            "chunk", "bucket", F.col(f"{kind}s").alias("keys"), F.col(f"{kind}_counts").alias("counts")
        )
        for kind in ("run", "word")
    }

    totals = staged(run_totals(requests["run"]), "totals")
    top = top_of(totals, depth)
    answers = answers_of(totals, top, depth, buckets)
    told = run_answers(requests["run"].drop("counts"), answers).unionByName(word_answers(requests["word"]))
    chunked = gathered.where("packed IS NOT NULL").select("chunk", "doc_id", "held", "learn", "size", "packed")

    def meet(text: pa.Table, found: pa.Table) -> pa.Table:
        return pa.table(_scored(text.to_pylist()[0], found, depth, buckets), schema=_shape(SCORED))

    scored = staged(chunked.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(meet, SCORED), "scored")
    sums = scored.agg(
        F.sum(F.when(F.col("learned"), F.col("n_tokens"))).alias("tokens"), F.sum("first_seen").alias("words")
    ).first()
    tokens, distinct = sums["tokens"] or 0, sums["words"] or 0
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("words") - F.col("n_tokens") * math.log10(tokens + 0.1 * (distinct + 1))).alias("base_score"),
        "score",
        (F.col("score") * (-math.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )


def _scored(row: dict, found: pa.Table, depth: int, buckets: int) -> dict[str, object]:
    data = zstandard.decompress(row["packed"])
    chunk = Chunk(data, row["size"], row["learn"], depth)
    n = len(chunk.sizes)
    run, place = sorted_runs(data, chunk.sizes, depth)
    begins = firsts(run)
    logs = _in_order(run[begins], found, "run", buckets)
    lengths = np.diff(np.append(begins, len(run)))
    del run
    score = np.bincount(place, weights=np.repeat(logs, lengths), minlength=n)

    keys, places, codes, counts = chunk.words()
    seen = _in_order(keys, found, "word", buckets)[places]
    logs = np.log10(seen + 0.1)
    place = np.repeat(np.arange(n), counts)
    return {
        "doc_id": pa.array(row["doc_id"], pa.int64()),
        "held_out": pa.array(row["held"], pa.bool_()),
        "learned": chunk.learn,
        "n_tokens": counts + 1,
        "n_known": np.bincount(place, weights=seen[codes] > 0, minlength=n).astype(np.int64) + int(seen[-1] > 0),
        "words": np.bincount(place, weights=logs[codes], minlength=n) + logs[-1],
        "score": score,
        "first_seen": np.append(sum(found.column("first_seen").to_pylist()), np.zeros(n - 1, np.int64)),
        "n_bytes": chunk.sizes,
    }


def _in_order(keys: np.ndarray, found: pa.Table, kind: str, buckets: int) -> np.ndarray:
    """The answers to a chunk's sorted keys."""
    order, numbers, _ = dealt(keys, buckets)
    rows = zip(*(found.column(name).to_pylist() for name in ("kind", "bucket", "packed")))
    parts = {bucket: packed for its, bucket, packed in rows if its == kind}
    values = np.empty(len(keys))
    told = np.float64 if kind == "run" else np.int64
    values[order] = np.concatenate([unpack(parts[number], told) for number in numbers.tolist()])
    return values
