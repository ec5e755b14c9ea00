"""Quality classifier from weak labels: heuristic labellers, expectation-maximisation over their
votes, and a linear scorer on hashed features trained on the posterior labels."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import batches, ship, texts
from orderloom.llm.quality_rules import Facts

GOOD, BAD, SILENT = 1, 0, 2
TRAIN_ROWS = 4000  # distinct texts the scorer is trained on, about, picked by their hash
BUCKETS = 1 << 14
THRESHOLD = 0.2  # below it a document counts as junk; in doubt it stays
STEPS = 400
_PLAIN = {kind + last for kind in ("a", "Aa") for last in ("", ".", ",")}  # shapes of ordinary words


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


class Signs(Facts):
    """Shares that the labellers look at, each worked out once for a text."""

    @cached_property
    def symbols(self) -> float:
        return _share(self.n_symbols, len(self.words))

    @cached_property
    def echoes(self) -> float:
        """Words equal to the one before."""
        return _share(sum(map(eq, self.words, self.words[1:])), len(self.words))

    @cached_property
    def repeats(self) -> float:
        return _share(self.n_repeat_words, len(self.words))

    @cached_property
    def same_lines(self) -> float:
        return _share(self.n_dup_lines, len(self.lines))

    @cached_property
    def capitals(self) -> float:
        return _share(sum(len(word) > 1 for word in filter(bytes.isupper, self.words)), len(self.words))

    @cached_property
    def shouting(self) -> float:
        return _share(self.text.count("!"), len(self.words))

    @cached_property
    def mean_length(self) -> float:
        return _share(self.word_chars, len(self.words))

    @cached_property
    def stops(self) -> float:
        return _share(sum(map(self.text.count, ".?!…。？！")), len(self.words))

    @cached_property
    def lettered(self) -> float:
        return _share(self.n_lettered, len(self.words))

    @cached_property
    def top_word(self) -> float:
        return _share(max(Counter(self.words).values(), default=0), len(self.words))


def _detects(sign: Callable[[Signs], bool]) -> Callable[[Signs], int]:
    """A labeller that knows one kind of junk and says nothing of other texts."""
    return lambda facts: BAD if sign(facts) else SILENT


def _vouches(sign: Callable[[Signs], bool]) -> Callable[[Signs], int]:
    return lambda facts: GOOD if sign(facts) else SILENT


LABELLERS: tuple[Callable[[Signs], int], ...] = (
    _detects(lambda f: f.symbols > 0.2),
    _detects(lambda f: f.echoes > 0.25 and len(f.words) >= 8),
    _detects(lambda f: f.repeats > 0.5),
    _detects(lambda f: f.same_lines > 0.5),
    _detects(lambda f: f.capitals > 0.5 and len(f.words) >= 4),
    _detects(lambda f: f.shouting > 0.3),
    _detects(lambda f: len(f.words) >= 20 and not 2 <= f.mean_length <= 14),
    _detects(lambda f: len(f.words) > 40 and not 0.005 <= f.stops <= 1),
    _detects(lambda f: len(f.words) >= 8 and f.lettered < 0.5),
    _detects(lambda f: len(f.words) >= 40 and f.top_word > 0.3),
    _vouches(lambda f: 0.02 <= f.stops <= 0.34 and f.shouting < 0.1),
    _vouches(lambda f: f.symbols < 0.02 and f.capitals < 0.2 and f.lettered > 0.8),
    _vouches(lambda f: f.repeats < 0.2 and f.echoes < 0.05),
    _vouches(lambda f: 3.5 <= f.mean_length <= 9 and f.n_dup_lines == 0),
)


def votes(text: str, labellers: tuple[Callable[[Signs], int], ...] = LABELLERS) -> int:
    """All votes as one number, a ternary digit for each labeller."""
    facts, pattern = Signs(text), 0
    for labeller in labellers:
        pattern = 3 * pattern + labeller(facts)
    return pattern


def vote_counts(docs: DataFrame) -> dict[int, int]:
    """How many documents have each pattern of votes: at most 3 ** labellers rows."""

    def prepare() -> Callable[[pa.RecordBatch], dict[str, object]]:
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            seen = Counter(map(votes, texts(batch.column(0))))
            return {"pattern": list(seen), "n": list(seen.values())}

        return work

    seen = batches(docs.select("text"), "pattern long, n long", prepare)
    return {row["pattern"]: row["n"] for row in seen.groupBy("pattern").agg(F.sum("n").alias("n")).collect()}


@dataclass(frozen=True)
class LabelModel:
    """The labellers' accuracies: chance[j, class, vote] and the share of good documents."""

    chance: np.ndarray
    prior: float

    def posterior(self, pattern: np.ndarray) -> np.ndarray:
        """Chance that a document of these votes is good."""
        cast = digits(pattern, len(self.chance))
        logs = np.log(self.chance)
        each = [logs[np.arange(len(logs)), k, cast].sum(axis=1) for k in (BAD, GOOD)]
        odds = each[GOOD] - each[BAD] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def digits(pattern: np.ndarray, count: int) -> np.ndarray:
    return pattern[:, None] // 3 ** np.arange(count - 1, -1, -1) % 3


def fit_labels(counts: dict[int, int], labellers: int = len(LABELLERS), rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over vote patterns, from a start that believes every detector.

    Each vote's chance is held up by a few imagined documents on which labellers are right,
    which settles which class is the good one, also where nothing or one kind was seen.
    """
    pattern = np.array(sorted(counts), np.int64)
    n = np.array([counts[k] for k in pattern.tolist()], float)
    cast = digits(pattern, labellers)
    belief = np.where((cast == BAD).any(axis=1), 0.1, 0.9)
    imagined = np.array([[4.0, 0.5, 4.0], [0.5, 4.0, 4.0]])  # by class: bad, good, silent
    model = None
    for _ in range(rounds):
        chance = np.empty((labellers, 2, 3))
        for k, weight in ((BAD, n * (1 - belief)), (GOOD, n * belief)):
            for vote in (BAD, GOOD, SILENT):
                chance[:, k, vote] = ((cast == vote) * weight[:, None]).sum(axis=0) + imagined[k, vote]
        chance /= chance.sum(axis=2, keepdims=True)
        prior = (float((n * belief).sum()) + 8) / (float(n.sum()) + 10)
        model = LabelModel(chance, prior)
        before, belief = belief, model.posterior(pattern)
        if not len(pattern) or np.abs(before - belief).max() < 1e-9:
            break
    return model


# The scorer -----------------------------------------------------------------------------


def shape(word: str) -> str:
    """Kinds of characters with runs made one: `Word,` is `Aa,`, `x###` is `a#`."""
    last = word[-1] if word[-1] in ".," and len(word) > 1 else ""
    stem = word[:-1] if last else word
    if stem.isalpha():  # most words
        if stem.islower():
            return "a" + last
        if stem[0].isupper() and stem[1:].islower():
            return "Aa" + last
    return "".join(_kinds(word))


def _kinds(word: str) -> list[str]:
    """Kinds of all characters of a word, with runs made one."""
    out = []
    for char in word:
        kind = "A" if char.isupper() else "a" if char.isalpha() else "0" if char.isdigit() else char
        if not out or out[-1] != kind:
            out.append(kind)
    return out


@lru_cache(maxsize=200_000)
def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % BUCKETS


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and values: shapes of words and of word pairs by their share, echoes,
    and the share of distinct words in steps. Words that are not plain, such as lines of a script
    without blanks, add the steps from kind to kind in them, by the characters they make up."""
    words = text.split()
    n = len(words)
    if not n:
        return np.array([_bucket("none")]), np.array([1.0])
    kinds = list(map(shape, words))
    found: Counter = Counter()
    for kind, times in Counter(kinds).items():
        found[_bucket(f"1 {kind}")] += (times / n) ** 0.5
    for (a, b), times in Counter(zip(kinds, kinds[1:])).items():
        found[_bucket(f"2 {a} {b}")] += (times / n) ** 0.5
    mixed = [(word, kind) for word, kind in zip(words, kinds) if kind not in _PLAIN]
    if mixed:
        steps: Counter = Counter()
        for _, kind in mixed:
            steps.update(zip(kind, kind[1:]))
        total, share = sum(steps.values()), sum(len(word) for word, _ in mixed) / sum(map(len, words))
        for (a, b), times in steps.items():
            found[_bucket(f"3 {a} {b}")] += (times / total * share) ** 0.5
    echoes = sum(map(eq, words, words[1:])) / n
    found[_bucket(f"echoes {int(10 * echoes)}")] += 1
    top = max(Counter(words).values()) / n if n >= 20 else 0
    found[_bucket(f"top {int(10 * top)}")] += 1
    mean = sum(map(len, words)) / n
    found[_bucket(f"length {min(int(mean), 20)}")] += 1
    return np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), float, len(found))


@dataclass(frozen=True)
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        at, value = features(text)
        return float(1 / (1 + np.exp(-np.clip(self.weights[at] @ value + self.bias, -50, 50))))


def train(samples: list[tuple[list[int], list[float], float]], steps: int = STEPS, ridge: float = 1e-4) -> Scorer:
    """Logistic regression on soft labels by accelerated gradient steps."""
    weights, bias = np.zeros(BUCKETS), 0.0
    if not samples:
        return Scorer(weights, 4.0)  # nothing is known against any text
    rows = np.repeat(np.arange(len(samples)), [len(x[0]) for x in samples])
    at = np.concatenate([x[0] for x in samples]).astype(np.int64)
    value = np.concatenate([x[1] for x in samples])
    label = np.array([x[2] for x in samples])
    speed, ahead, bias_speed = np.zeros(BUCKETS), weights, 0.0
    rate = 4 / max(1.0, float((np.bincount(rows, value**2, len(samples)) + 1).max()))
    for step in range(steps):
        momentum = step / (step + 3)
        ahead, ahead_bias = weights + momentum * speed, bias + momentum * bias_speed
        margin = np.bincount(rows, ahead[at] * value, len(samples)) + ahead_bias
        error = 1 / (1 + np.exp(-np.clip(margin, -50, 50))) - label
        slope = np.bincount(at, error[rows] * value, BUCKETS) / len(samples) + ridge * ahead
        new, new_bias = ahead - rate * slope, ahead_bias - rate * error.mean()
        speed, bias_speed, weights, bias = new - weights, new_bias - bias, new, new_bias
    return Scorer(weights, float(bias))


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Scorer:
    """The scorer for these documents: labellers' accuracies from the votes of all of them,
    weights from about `train_rows` distinct texts.

    Texts are picked by a hash and put in its order, so the scorer follows from the rows alone,
    not from how they lie in files, and copies of a text are one.
    """
    ship(docs.sparkSession)
    model = fit_labels(vote_counts(docs))
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text"))
    total = rows.select("mark").distinct().count()

    def prepare() -> Callable[[pa.RecordBatch], dict[str, object]]:
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            found = texts(batch.column(0))
            hashed = list(map(features, found))
            pattern = np.array(list(map(votes, found)), np.int64)
            return {
                "mark": batch.column(1),
                "at": [x[0].tolist() for x in hashed],
                "value": [x[1].tolist() for x in hashed],
                "label": model.posterior(pattern) if len(pattern) else [],
            }

        return work

    # The upper bits of a hash of the hash, as texts are told apart by the hash itself.
    place = F.shiftrightunsigned(F.xxhash64("mark"), 33)
    picked = rows.where(place < int(min(1.0, train_rows / max(total, 1)) * (1 << 31)))
    distinct = picked.groupBy("mark").agg(F.any_value("text").alias("text")).select("text", "mark")
    found = batches(distinct, "mark long, at array<int>, value array<double>, label double", prepare).collect()
    return train([(row["at"], row["value"], row["label"]) for row in sorted(found, key=lambda row: row["mark"])])


def weak_label_scores(docs: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, kept) of every input row; `kept` means a score of `threshold` or more.

    A null or empty text has a single feature of its own and hardly any votes, so its score
    follows the share of good documents. Repeated rows are scored each; other
    columns are ignored; an empty table gives no rows.
    """
    scorer = docs.sparkSession.sparkContext.broadcast(fit(docs, train_rows))

    def prepare() -> Callable[[pa.RecordBatch], dict[str, object]]:
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            score = [scorer.value.score(text) for text in texts(batch.column(1))]
            return {"doc_id": batch.column(0), "score": score, "kept": [x >= threshold for x in score]}

        return work

    return batches(
        docs.select(F.col("doc_id").cast("long"), "text"), "doc_id long, score double, kept boolean", prepare
    )


def kept_documents(docs: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text scores `threshold` or more, all columns unchanged.

    A null or empty text scores as `weak_label_scores` says, and repeated rows alike; an empty
    table stays empty.
    """
    scorer = docs.sparkSession.sparkContext.broadcast(fit(docs, train_rows))
    at = docs.columns.index("text")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            keep = [scorer.value.score(text) >= threshold for text in texts(batch.column(at))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
