"""Collocations: phrases of 2 to 5 words that hold together, from suffix trees built in groups.

Every word of a piece of text begins a suffix of at most five words. A tree over all suffixes
would not fit one task, so it is partitioned by its prefixes first and built group by group:

1. words are counted, and pairs of frequent words. A phrase is frequent only if all its words and
   pairs are, so a suffix ends before the first word or pair that is not. Which ones are frequent
   is known to tasks from bitmaps of bounded size, by hash: a false hit lets a suffix go on that
   need not have, and changes no count;
2. equal suffixes are one row with their number, within a task first;
3. a prefix whose rows exceed the memory budget is made longer, word by word, and prefixes are
   dealt to so many groups that each holds about one budget of rows;
4. each group sorts its suffixes, which puts its subtrees in order, cut off below depth five. The
   total of the leaves under a node is the count of the phrase that leads to it. Nodes above a
   prefix that was made longer have their totals from step 3.

Words are known by 64 bits of a hash of language and word.
"""

from __future__ import annotations

from array import array
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from orderloom.llm.bitmaps import BITMAP_BITS, Bitmap, bitmap
from orderloom.llm.common import ship
from orderloom.operators.lookups import sized
from orderloom.session import staged

DEPTH = 5
MIN_COUNT = 100
TOP = 2000
GROUP_ROWS = 1 << 20  # suffixes in a group, some 50 MB
CHUNK_WORDS = 1 << 20  # words that a task looks at together, or one longer text
WORDS_KEPT = 1 << 18  # words that a task remembers before it starts anew, some 50 MB

# What ends a piece, by the contract.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_BREAK = b"\xff"  # in no UTF-8 text
_FOLD = bytes(0xFF if b in _ENDS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_WORDS = [f"w{k}" for k in range(1, DEPTH + 1)]


def tokens(text: str) -> list[bytes]:
    """The words of a text, with a break where a piece ends."""
    folded = text.encode("utf-8", "surrogatepass").translate(_FOLD)
    return folded.replace(_BREAK, b" \xff ").split()


def _streamed(df: DataFrame, schema: str, prepare: Callable[[], Callable[[Iterator[pa.RecordBatch]], Iterator[list]]]) -> DataFrame:
    """The batches of each task through a generator of lists of columns."""
    ship(df.sparkSession)
    result = StructType.fromDDL(schema)
    shape = to_arrow_schema(result)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in prepare()(parts):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, shape)], schema=shape)

    return df.mapInArrow(run, result)


def _by_lang(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
    for part in parts:
        for lang, text in zip(part.column(0), part.column(1)):
            yield lang.as_py(), text.as_py()


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, key, n) of all words, `docs` being (lang, text) without nulls."""

    def prepare() -> Callable[[Iterator[pa.RecordBatch]], Iterator[list]]:
        def work(parts: Iterator[pa.RecordBatch]) -> Iterator[list]:
            counts: dict[str, Counter] = defaultdict(Counter)
            for lang, text in _by_lang(parts):
                counts[lang].update(tokens(text))
                if sum(map(len, counts.values())) > WORDS_KEPT:
                    yield from flush(counts)
            yield from flush(counts)

        def flush(counts: dict[str, Counter]) -> Iterator[list]:
            for lang, found in counts.items():
                found.pop(_BREAK, None)
                words = [word.decode("utf-8", "surrogatepass") for word in found]
                yield [[lang] * len(words), words, list(found.values())]
            counts.clear()

        return work

    counts = _streamed(docs, "lang string, word string, n long", prepare).groupBy("lang", "word")
    return counts.agg(F.sum("n").alias("n")).select("lang", "word", F.xxhash64("lang", "word").alias("key"), "n")


class _Lexicon(dict):
    """Numbers of the words of a language that a task has met, and their hashes; 0 is the break."""

    def __init__(self, lang: str, frequent: Bitmap):
        super().__init__({_BREAK: 0})
        self.seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 42)
        self.keys = array("Q", [0])
        self.frequent = frequent

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.keys)
        self.keys.append(xxhash.xxh64_intdigest(word, self.seed))
        return number

    def known(self) -> tuple[np.ndarray, np.ndarray]:
        """The hash of each number, and whether it may be a frequent word."""
        keys = np.frombuffer(self.keys, np.uint64).copy()
        good = self.frequent.holds(keys)
        good[0] = False
        return keys, good


def _runs(parts: Iterator[pa.RecordBatch], frequent: Bitmap, chunk: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Word numbers of whole texts of a language, a chunk at a time, with what is known of them."""
    lexicons: dict[str, _Lexicon] = {}
    held: dict[str, list[int]] = defaultdict(list)

    def run(lang: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(held.pop(lang), np.int64), *lexicons[lang].known()

    for lang, text in _by_lang(parts):
        lexicon = lexicons.get(lang)
        if lexicon is None:
            lexicon = lexicons[lang] = _Lexicon(lang, frequent)
        held[lang].extend(map(lexicon.__getitem__, tokens(text)))
        held[lang].append(0)
        if len(held[lang]) >= chunk:
            yield run(lang)
        if sum(map(len, lexicons.values())) > WORDS_KEPT:
            for each in list(held):
                yield run(each)
            lexicons.clear()
    for each in list(held):
        yield run(each)


def _pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left ^ (left >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + right
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


def pair_counts(docs: DataFrame, frequent: Bitmap, chunk: int = CHUNK_WORDS) -> DataFrame:
    """(key, n) of pairs of words that may both be frequent."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def prepare() -> Callable[[Iterator[pa.RecordBatch]], Iterator[list]]:
        def work(parts: Iterator[pa.RecordBatch]) -> Iterator[list]:
            for run, keys, good in _runs(parts, sent.value, chunk):
                fits = good[run]
                at = np.flatnonzero(fits[:-1] & fits[1:])
                pairs, counts = np.unique(run[at] << 32 | run[at + 1], return_counts=True)
                found = _pair_keys(keys[pairs >> 32], keys[pairs & 0xFFFFFFFF])
                yield [found.view(np.int64), counts]

        return work

    return _streamed(docs, "key long, n long", prepare).groupBy("key").agg(F.sum("n").alias("n"))


def suffix_counts(docs: DataFrame, frequent: Bitmap, pairs: Bitmap, chunk: int = CHUNK_WORDS) -> DataFrame:
    """(w1 to w5, n): the distinct suffixes of two words or more and how often each begins.

    A suffix ends with its piece, after five words, or before what is not frequent; zeros follow.
    """
    context = docs.sparkSession.sparkContext
    sent, sent_pairs = context.broadcast(frequent), context.broadcast(pairs)

    def prepare() -> Callable[[Iterator[pa.RecordBatch]], Iterator[list]]:
        def work(parts: Iterator[pa.RecordBatch]) -> Iterator[list]:
            for run, keys, good in _runs(parts, sent.value, chunk):
                fits = good[run]
                at = np.flatnonzero(fits[:-1] & fits[1:])
                goes_on = np.zeros(len(run) + DEPTH, bool)
                goes_on[at] = sent_pairs.value.holds(_pair_keys(keys[run[at]], keys[run[at + 1]]))
                begins = np.flatnonzero(goes_on)
                columns, reached = [run[begins]], np.ones(len(begins), bool)
                for k in range(1, DEPTH):
                    reached = reached & goes_on[begins + k - 1]
                    columns.append(np.where(reached, run[np.minimum(begins + k, len(run) - 1)], 0))
                first, counts = _distinct(columns)
                yield [keys[column[first]].view(np.int64) for column in columns] + [counts]

        return work

    rows = _streamed(docs, ", ".join(f"{name} long" for name in [*_WORDS, "n"]), prepare)
    return rows.groupBy(*_WORDS).agg(F.sum("n").alias("n"))


def _distinct(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct row and its number of rows. Runs of words get a number each,
    which with the next words makes the numbers of longer runs."""
    number = columns[0]
    for k, column in enumerate(columns[1:], 2):
        both = number << 32 | column
        if k == len(columns):
            return np.unique(both, return_index=True, return_counts=True)[1:]
        number = np.unique(both, return_inverse=True)[1]
    raise ValueError("a suffix has two words at least")


def partitioned(suffixes: DataFrame, budget: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """The suffixes with the `prefix` length they are partitioned by and their `group`, and the
    counts (words, n) of prefixes of two words or more that were made longer."""
    total = suffixes.count()
    groups = max(1, -(-total // budget))
    rows, longer = suffixes.withColumn("prefix", F.lit(1)), None
    for length in range(1, DEPTH):
        words = _WORDS[:length]
        heavy = rows.where(F.col("prefix") == length).groupBy(*words).agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"))
        # Never more than one for each budget of rows.
        heavy = staged(heavy.where(F.col("rows") > budget), "heavy-prefixes")
        if heavy.isEmpty():
            break
        if length > 1:
            counted = heavy.select(F.array(*words).alias("words"), "n")
            longer = counted if longer is None else longer.unionByName(counted)
        mark = sized(heavy.select(*words, F.lit(True).alias("heavy")))
        rows = rows.join(mark, words, "left").withColumn(
            "prefix", F.when(F.col("heavy"), length + 1).otherwise(F.col("prefix"))
        ).drop("heavy")
    held = [F.when(F.col("prefix") > k, F.col(name)).otherwise(0) for k, name in enumerate(_WORDS)]
    group = F.pmod(F.xxhash64("prefix", *held), F.lit(groups))
    return rows.select(*_WORDS, "n", "prefix", group.alias("group")), longer


def phrase_counts(suffixes: DataFrame, min_count: int = MIN_COUNT, budget: int = GROUP_ROWS) -> DataFrame:
    """(words, n): every phrase of two words or more that occurs `min_count` times."""
    ship(suffixes.sparkSession)
    dealt, longer = partitioned(suffixes, budget)
    whole = dealt.groupBy("group").applyInArrow(lambda table: _subtrees(table, min_count), "words array<long>, n long")
    if longer is not None:
        whole = whole.unionByName(longer.where(F.col("n") >= min_count))
    return whole


def _subtrees(table: pa.Table, min_count: int) -> pa.Table:
    """Phrases at the nodes of a group's subtrees, of those below the prefixes it was dealt by."""
    words = np.stack([table[name].to_numpy() for name in _WORDS], axis=1)
    order = np.lexsort(words.T[::-1])
    words, n, prefix = words[order], table["n"].to_numpy()[order], table["prefix"].to_numpy()[order]
    same = np.ones(len(words), bool)  # whether a row is under the same node as the row before
    same[0] = False
    phrases, counts = [], []
    for depth in range(1, DEPTH + 1):
        same[1:] &= words[1:, depth - 1] == words[:-1, depth - 1]
        starts = np.flatnonzero(~same)
        leaves = np.add.reduceat(n, starts)
        kept = (leaves >= min_count) & (words[starts, depth - 1] != 0) & (prefix[starts] <= depth) & (depth > 1)
        phrases += list(words[starts[kept], :depth])
        counts += leaves[kept].tolist()
    return pa.table({"words": pa.array(phrases, pa.list_(pa.int64())), "n": pa.array(counts, pa.int64())})


def _part(column: str, start: int | Column, length: int | Column) -> Column:
    as_column = lambda x: F.lit(x) if isinstance(x, int) else x
    return F.slice(column, as_column(start), as_column(length))


def scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """(words, a, l, r, score, lang, n) of the candidates at their weakest cut.

    `words` has (key, lang, f, n): each frequent word's count, and that of all its language's words.
    Counts are multiplied as decimals of 38 digits, so they may have 17 digits each.
    """
    counts = phrases.select("words", F.col("n").alias("f")).unionByName(words.select(F.array("key").alias("words"), "f"))
    counts = staged(counts, "phrase-counts")
    size = F.size("words")
    cuts = phrases.select("words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("words", "a", "k", _part("words", 1, F.col("k")).alias("first"), _part("words", F.col("k") + 1, size - F.col("k")).alias("rest"))
    left = counts.select(F.col("words").alias("first"), F.col("f").alias("l"))
    right = counts.select(F.col("words").alias("rest"), F.col("f").alias("r"))
    here = words.select(F.col("key").alias("head"), "lang", "n")
    both = cuts.join(left, "first").join(right, "rest").withColumn("head", F.col("words")[0]).join(here, "head")

    def exact(name: str, digits: int) -> Column:
        return F.col(name).cast(f"decimal({digits},0)")

    thousandfold = (exact("a", 17) * F.lit(1000).cast("decimal(4,0)")) * exact("n", 17)
    score = F.call_function("div", thousandfold, exact("l", 17) * exact("r", 17))
    weakest = both.select("words", "a", "lang", "n", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    lowest = weakest.groupBy("words").agg(
        F.min("cut").alias("cut"), *[F.any_value(name).alias(name) for name in ("a", "lang", "n")]
    )
    return lowest.select("words", "lang", "a", "cut.l", "cut.r", "n", "cut.score")


def maximal(phrases: DataFrame) -> DataFrame:
    """Phrases that no longer phrase holds as often as they occur. One more word is enough to
    look at: what lies in a phrase of equal count lies in one of each length between."""
    size = F.size("words") - 1
    inner = F.explode(F.array(_part("words", 1, size), _part("words", 2, size)))
    covered = phrases.where("size(words) > 2").select(inner.alias("words"), "n").groupBy("words").agg(F.max("n").alias("most"))
    both = phrases.join(staged(covered, "covered"), "words", "left")
    return both.where("most IS NULL OR 100 * most < 100 * n").drop("most")


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    top: int = TOP,
    budget: int = GROUP_ROWS,
    chunk: int = CHUNK_WORDS,
    bitmap_bits: int = BITMAP_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` collocations.

    A null text is empty and a null lang is `und`. Empty texts have no words; texts of any length
    are read whole; repeated rows count each. Equal scores are ordered by count, then by phrase in
    UTF-8 order, so ranks have no ties. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words = staged(word_counts(rows), "word-counts")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = staged(
        words.withColumnRenamed("n", "f").where(F.col("f") >= min_count).join(staged(totals, "word-totals"), "lang"), "frequent-words"
    )
    known = bitmap(frequent.select("key"), bitmap_bits)
    pairs = staged(pair_counts(rows, known, chunk).where(F.col("n") >= min_count), "frequent-pairs")
    suffixes = staged(suffix_counts(rows, known, bitmap(pairs, bitmap_bits), chunk), "suffixes")
    phrases = staged(phrase_counts(suffixes, min_count, budget), "phrases")
    kept = scored(phrases, frequent.select("key", "lang", "f", "n")).join(maximal(phrases).select("words"), "words", "left_semi")

    best = [F.desc("score"), F.desc("a")]
    # Those beyond the limit are cut in each task; what ties there stays until the text is known.
    near = kept.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("place") <= top)
    near = staged(near.drop("place"), "best-phrases")
    spelled = near.select("words", F.posexplode("words").alias("at", "key")).join(frequent.select("key", "word"), "key")
    texts = spelled.groupBy("words").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("parts"))
    texts = texts.select("words", F.concat_ws(" ", "parts.word").alias("phrase"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best, F.asc("phrase")))
    named = near.join(texts, "words").withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return named.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


# The limits and the classes of characters of the contract.
SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(
        regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), numbered AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, array_to_string(w[i:i + len - 1], ' ') AS phrase, len
    FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM numbered) CROSS JOIN range(1, 6) AS lens(len)
    WHERE i + len - 1 <= len(w)
), counts AS (
    SELECT lang, phrase, len, count(*) AS f FROM grams GROUP BY lang, phrase, len
    HAVING count(*) >= 100
), totals AS (
    SELECT lang, sum(len(w))::hugeint AS n FROM numbered GROUP BY lang
), candidates AS (
    SELECT lang, phrase, len, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE len > 1
), cuts AS (
    SELECT c.lang, c.phrase, c.len, c.a, k, x.f AS l, y.f AS r, t.n,
           (1000::hugeint * c.a * t.n) // (x.f::hugeint * y.f) AS score
    FROM candidates c CROSS JOIN range(1, 5) AS ks(k)
    JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:k], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
    JOIN totals t ON t.lang = c.lang
    WHERE k < c.len
), weakest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
    SELECT * FROM weakest s WHERE NOT EXISTS (
        SELECT 1 FROM candidates b WHERE b.lang = s.lang AND b.len > s.len AND 100 * b.a >= 100 * s.a
          AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' '))
)
SELECT lang, cast(rank AS bigint) AS rank, phrase, cast(a AS bigint) AS a, cast(l AS bigint) AS l, cast(r AS bigint) AS r,
       cast(n AS bigint) AS n, cast(score AS bigint) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
WHERE rank <= 2000
"""
