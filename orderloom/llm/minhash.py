"""MinHash near-duplicates by an inverted join over signature coordinates.

A document's set is that of its distinct word shingles. Each distinct set gets a signature of 64
coordinates: the least value of its shingles under 64 permutations. Of two sets that overlap by
85 %, a coordinate is equal with a chance of 0.85, so fewer than 34 of 64 agree once in 10^8
pairs; that is the match threshold. Then

- sets are posted under each coordinate and value; what nobody else has can match nothing, and a
  set with fewer than 34 shared coordinates has no partner at all;
- of its s shared coordinates a set needs only the s - 33 rarest: two sets that agree in 34 have
  one of these in common, whichever way the order of rarity is cut (prefix merging). Values that
  very many sets have are thus skipped by all sets that have rarer ones;
- collisions are counted within each posting list, in strips of coordinates, of which a set that
  can no longer reach the threshold skips the rest. Sets that are connected already are skipped;
- the groups that this leaves are compared again on their full sets, read once more from the
  texts of one document for each set.

A list or group may hold a third of all sets: see `forests`. Shingles and sets are told apart by
64 bits of a hash.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.bitmaps import bitmap
from orderloom.llm.common import batches, texts
from orderloom.llm.components import components
from orderloom.llm.forests import Compare, linked
from orderloom.session import sized, staged

SHINGLE = 5
SHARE = 85  # of the union, in %, that the intersection must reach
COORDINATES = 64
MATCHES = 34
STRIP = 16  # coordinates counted between two looks at what can still reach the threshold
LIST_LIMIT = 2048  # signatures in a tile
SET_LIMIT = 1 << 21  # shingles in a tile, 16 MB
WORDS_KEPT = 1 << 17  # words a task remembers the hash of before it starts anew, some 25 MB
SEED = 13

_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word, SEED)
        return value


class Shingler:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, shingle: int = SHINGLE):
        self.shingle = shingle
        self.hashes = _Hashes()

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split()
        if len(self.hashes) > WORDS_KEPT:
            self.hashes = _Hashes()
        row = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        size = min(self.shingle, len(words))
        if not size:
            return row
        places = len(words) - size + 1
        whole = np.full(places, size, np.uint64)  # a short text is no shingle of a longer one
        for k in range(size):
            whole = _mixed(whole + row[k : k + places])
        return np.unique(whole)


def permutations(coordinates: int) -> np.ndarray:
    """Odd factors: multiplied by one, 64-bit values change places with each other."""
    return _mixed(np.arange(1, coordinates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The upper 32 bits of the least value under each permutation; zeros for no shingles."""
    least = np.full(len(factors), np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048, None] * factors[None, :]
        least = np.minimum(least, part.min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32) if len(shingles) else np.zeros(len(factors), np.uint32)


_MARKS = "doc_id long, mark long, node long, n_shingles long, signature array<int>"


def signatures(docs: DataFrame, shingle: int = SHINGLE, coordinates: int = COORDINATES) -> DataFrame:
    """A row per document: its id, a hash of its text, of its set (null for an empty one), the
    set's size and signature."""
    factors = permutations(coordinates)

    def prepare() -> Callable[[pa.RecordBatch], dict[str, object]]:
        shingles_of = Shingler(shingle)

        def work(batch: pa.RecordBatch) -> dict[str, object]:
            nodes, sizes, signs = [], [], []
            for text in texts(batch.column(1)):
                found = shingles_of(text)
                nodes.append(_node(found) if len(found) else None)
                sizes.append(len(found))
                signs.append(signature(found, factors).view(np.int32) if len(found) else None)
            return {
                "doc_id": batch.column(0),
                "mark": batch.column(2),
                "node": nodes,
                "n_shingles": sizes,
                "signature": pa.array(signs, pa.list_(pa.int32())),
            }

        return work

    return batches(docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text")), _MARKS, prepare)


def _node(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.astype("<u8").tobytes(), SEED)).view(np.int64))


def postings(nodes: DataFrame, matches: int = MATCHES, entered: int | None = None) -> DataFrame:
    """(list, node) under the rarest coordinate values that each set must be posted under.

    `entered` is the number of all coordinates, which no step has more rows than.
    """
    entered = COORDINATES * nodes.count() if entered is None else entered
    # A value takes the lower half of a token, the place of its coordinate the upper one.
    token = F.shiftleft(F.col("place").cast("long"), 32) + F.col("value").bitwiseAND(F.lit((1 << 32) - 1))
    entries = nodes.select("node", F.posexplode("signature").alias("place", "value")).select("node", token.alias("token"))
    shared = entries.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = staged(sized(shared, entered), "shared-coordinates")
    held = sized(entries.join(shared, "token"), entered).groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("n", "token"))).alias("tokens")
    )
    rarest = F.slice("tokens", F.lit(1), F.size("tokens") - (matches - 1))
    lists = held.where(F.size("tokens") >= matches).select("node", F.explode(rarest).alias("entry"))
    return lists.select(F.col("entry.token").alias("list"), "node")


def _by_collisions(matches: int) -> Callable[[pa.Table], Compare]:
    def prepare(table: pa.Table) -> Compare:
        signs = table["signature"].combine_chunks().flatten().to_numpy().reshape(len(table), -1)
        width = signs.shape[1]

        def compare(place: int, others: np.ndarray) -> np.ndarray:
            left = np.arange(len(others))
            count = np.zeros(len(others), np.int64)
            for at in range(0, width, STRIP):
                strip = slice(at, at + STRIP)
                count += (signs[others[left], strip] == signs[place, strip]).sum(axis=1)
                open_still = count + max(0, width - at - STRIP) >= matches
                left, count = left[open_still], count[open_still]
                if not len(left):
                    break
            hits = np.zeros(len(others), bool)
            hits[left] = True
            return hits

        return compare

    return prepare


def _by_sets(share: int) -> Callable[[pa.Table], Compare]:
    def prepare(table: pa.Table) -> Compare:
        column = table["shingles"].combine_chunks()
        values = column.flatten().to_numpy()
        sizes = np.diff(column.offsets.to_numpy())
        ids = np.unique(values, return_inverse=True)[1]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        inside = np.zeros(len(ids) + 1, bool)

        def compare(place: int, others: np.ndarray) -> np.ndarray:
            own, theirs = sizes[place], sizes[others]
            # Sets whose sizes alone keep them apart are not looked at.
            near = np.flatnonzero(100 * np.minimum(own, theirs) >= share * np.maximum(own, theirs))
            hits = np.zeros(len(others), bool)
            mine = ids[starts[place] : starts[place + 1]]
            inside[mine] = True
            for k in near:
                other = others[k]
                common = int(np.count_nonzero(inside[ids[starts[other] : starts[other + 1]]]))
                hits[k] = 100 * common >= share * (own + theirs[k] - common)
            inside[mine] = False
            return hits

        return compare

    return prepare


def _key(doc_id: Column, mark: Column) -> Column:
    return F.xxhash64(doc_id, mark).alias("key")


def shingle_sets(docs: DataFrame, chosen: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(node, weight, shingles) of the documents named by (doc_id, mark) in `chosen`.

    Most texts are dropped by a bitmap in the task that makes the sets, so that it has one Python
    worker; the few others that the bitmap lets pass are dropped by the join.
    """
    spark = docs.sparkSession
    wanted = staged(chosen.select(_key(F.col("doc_id"), F.col("mark"))), "chosen-keys")
    sent = spark.sparkContext.broadcast(bitmap(wanted))
    keyed = docs.select(_key(F.col("doc_id").cast("long"), F.xxhash64("text")), "text")

    def prepare() -> Callable[[pa.RecordBatch], dict[str, object]]:
        shingles_of = Shingler(shingle)

        def work(batch: pa.RecordBatch) -> dict[str, object]:
            held = np.flatnonzero(sent.value.holds(batch.column(0).to_numpy().view(np.uint64)))
            sets = [shingles_of(batch.column(1)[int(k)].as_py() or "") for k in held]
            return {
                "key": batch.column(0).take(pa.array(held)),
                "node": [_node(found) for found in sets],
                "weight": [len(found) for found in sets],
                "shingles": pa.array([found.view(np.int64) for found in sets], pa.list_(pa.int64())),
            }

        return work

    # Rows that share id and text are all found; one of them is enough.
    sets = batches(keyed, "key long, node long, weight long, shingles array<long>", prepare)
    found = sets.join(wanted, "key", "left_semi").drop("key")
    return staged(found.dropDuplicates(["node"]), "shingle-sets")


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    share: int = SHARE,
    coordinates: int = COORDINATES,
    matches: int = MATCHES,
    list_limit: int = LIST_LIMIT,
    set_limit: int = SET_LIMIT,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every input row.

    component_id is the smallest doc_id reachable over links, kept whether that is the row's own.
    Null, empty and wordless texts have no shingles and are linked with nothing: they are their
    own component. Equal sets are one node, so copies make no links. A null doc_id takes part
    and is smallest only where no other id is reachable; component_id is then null, and the row
    kept. Repeated rows are kept as rows and get the same result. Other columns are ignored; an
    empty table gives no rows. `matches` belongs to `share` and `coordinates`.
    """
    marks = staged(signatures(docs, shingle, coordinates), "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")).alias("first")
    nodes = marks.where("node IS NOT NULL").groupBy("node").agg(first, F.any_value("signature").alias("signature"))
    nodes = staged(nodes, "sets")
    entered = coordinates * nodes.count()

    lists = staged(sized(postings(nodes, matches, entered), entered), "postings")
    signs = nodes.select("node", F.lit(1).cast("long").alias("weight"), "signature").join(
        sized(lists.select("node").distinct(), entered), "node", "left_semi"
    )
    signs = staged(sized(signs, entered), "posted-signatures")
    near = linked(lists, signs, _by_collisions(matches), list_limit)
    roots = components(near)
    heads = sized(roots.select(F.col("root").alias("node"), "root").distinct(), entered)
    groups = staged(roots.unionByName(heads).select(F.col("root").alias("list"), "node"), "near-groups")

    chosen = nodes.join(groups, "node").select("first.doc_id", "first.mark")
    chosen = staged(sized(chosen, entered), "chosen")
    sets = shingle_sets(docs, chosen, shingle)
    confirmed = components(linked(groups, sets, _by_sets(share), set_limit))

    named = nodes.select("node", "first.doc_id").join(confirmed, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    named = staged(sized(named, entered), "named")
    lowest = staged(sized(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), entered), "lowest")
    labels = staged(sized(named.join(lowest, "root").select("node", "component_id"), entered), "labels")
    wordy = marks.where("node IS NOT NULL").select("doc_id", "n_shingles", "node").join(labels, "node")
    empty = marks.where("node IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    rows = wordy.select("doc_id", "n_shingles", "component_id").unionByName(empty)
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


# The shingle length, the share of the union and the class of words.
SQL = r"""
WITH RECURSIVE doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, list_sort(list_distinct(CASE
        WHEN coalesce(len(w), 0) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS shingles
    FROM doc_words
), hashed AS (
    SELECT doc_id, len(shingles) AS n_shingles, CASE WHEN len(shingles) > 0 THEN md5(array_to_string(shingles, chr(10))) END AS node,
           shingles
    FROM sets
), nodes AS (
    SELECT node, any_value(n_shingles) AS n, min(doc_id) AS least, any_value(shingles) AS shingles
    FROM hashed WHERE node IS NOT NULL GROUP BY node
), entries AS (
    SELECT node, n, unnest(shingles) AS shingle FROM nodes
), links AS (
    SELECT a.node AS a, b.node AS b
    FROM entries a JOIN entries b ON a.shingle = b.shingle AND a.node <> b.node
    GROUP BY a.node, b.node, a.n, b.n
    HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(a, b) AS (
    SELECT node, node FROM nodes
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), labels AS (
    SELECT reach.a AS node, min(nodes.least) AS component_id
    FROM reach JOIN nodes ON reach.b = nodes.node GROUP BY reach.a
)
SELECT hashed.doc_id, cast(n_shingles AS bigint) AS n_shingles,
       CASE WHEN hashed.node IS NULL THEN hashed.doc_id ELSE component_id END AS component_id,
       CASE WHEN hashed.node IS NULL THEN true ELSE coalesce(hashed.doc_id = component_id, hashed.doc_id IS NULL AND component_id IS NULL) END AS kept
FROM hashed LEFT JOIN labels ON hashed.node = labels.node
"""
