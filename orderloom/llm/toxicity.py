"""Toxicity by a weighted lexicon, matched by Aho-Corasick after folding look-alike characters.

The lexicon is a list of words known beforehand and of stems that labelled texts show to be
toxic in any language: beginnings of words, whole words where they are short, and runs of
characters in scripts that are written without blanks. A text's hits, weighted and set in
relation to its length, go through a logistic curve fitted to the labels. Hits inside exception
phrases do not count.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import batches, is_residue, learnable, texts
from orderloom.session import staged

HELD_MODULUS, HELD_RESIDUE = 4, 2
LABELLED_ROWS = 6000  # labelled documents per label that lexicon and curve are fitted to
THRESHOLD = 0.3
STEM_CHARS = range(4, 9)  # lengths of word beginnings that are tried
SHORT_CHARS = range(2, 4)  # lengths of whole words that are tried
RUN_CHARS = range(2, 5)  # lengths of runs that are tried in scripts without blanks
WHOLE = "$"  # after a stem that is a whole word; no letter, so in no other stem
LEAST_GAIN = 12  # log-likelihood that a stem must tell

# Words known beforehand, with the weight they have until labels say otherwise.
SEEDS = {
    "idiot": 3.0, "moron": 3.0, "stupid": 2.5, "loser": 2.5, "scum": 3.0, "trash": 2.0,
    "worthless": 2.5, "pathetic": 2.5, "disgusting": 2.5, "clown": 2.0, "imbecile": 3.0,
    "dumbass": 3.5, "bastard": 3.0, "asshole": 3.5, "bitch": 3.0, "fuck": 3.0, "shithead": 3.5,
    "bullshit": 2.5, "retard": 3.0, "filthy": 1.5, "vermin": 2.5, "dipshit": 3.5, "jackass": 3.0,
    "dickhead": 3.5, "wanker": 3.0, "whore": 3.0, "slut": 3.0, "douchebag": 3.0, "lowlife": 2.5,
    "degenerate": 1.5, "halfwit": 2.5, "cretin": 2.5, "nitwit": 2.0, "garbage": 1.5,
}
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "trash collection", "garbage can", "garbage collection",
    "garbage collector", "garbage truck", "clown fish", "clownfish", "circus clown", "scum line",
    "pond scum", "degenerate matter", "degenerate case", "retardant", "flame retard", "filthy rich",
    "idiot proof", "idiot light",
)

# Letters of other scripts that look like Latin ones, and what stands for letters.
_ALIKE = dict(
    zip(
        "авекмнорстухіјѕԁԛԝһӏ" + "αβεικνορτυχγ",
        "abekmhopctyxijsdqwhl" + "abeikvoptuxy",
    )
)
_FOLD = {ord(a): b for a, b in _ALIKE.items()}
_FOLD |= {0xFF41 + k: chr(0x61 + k) for k in range(26)}  # full-width letters
_FOLD |= {code: None for code in (0x00AD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}  # unseen
_STANDS_FOR = str.maketrans("013457@$!|", "oieastasii")
_SIGN = re.compile(r"[013457@$!|]")
_DISGUISED = re.compile(r"(?<![^\W_])[a-z]*[013457@$!|][a-z013457@$!|]*[a-z](?![^\W_])")
# A word with a letter in it that ends in a digit or sign, other than one that ends a sentence.
_OPEN_END = re.compile(r"(?<![^\W_])[013457@$!|]*[a-z][a-z013457@$!|]*(?<=[013457@$|])(?![^\W_])")
_WORD = re.compile(r"[^\W\d_]+")
# Thai and Lao, Myanmar, Khmer, Japanese syllables, and Han, which set no blanks.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff]+")


def folded(text: str, known: Mapping[str, float] = SEEDS) -> str:
    """Lower case, look-alikes as Latin letters, and digits or signs inside words as letters.

    A word's last digits and signs are read as letters if that makes a word of the lexicon or
    one that begins like it, since numbers and prices end so as well.
    """
    text = text.lower()
    if not text.isascii():
        text = text.translate(_FOLD)
    if not _SIGN.search(text):
        return text
    return _OPEN_END.sub(lambda found: _known_or_as_is(found.group(), known), _DISGUISED.sub(_undisguised, text))


def _known_or_as_is(word: str, known: Mapping[str, float]) -> str:
    letters = word.translate(_STANDS_FOR)
    begins = any(letters[:size] in known for size in range(STEM_CHARS.start, len(letters) + 1))
    return letters if begins or letters + WHOLE in known else word


def _undisguised(found: re.Match) -> str:
    word = found.group()
    letters = sum(c.isalpha() for c in word)
    return word.translate(_STANDS_FOR) if letters > 1 else word


@dataclass(frozen=True)
class Model:
    """Weighted word beginnings, and the curve from measures to a chance."""

    stems: tuple[tuple[str, float], ...]
    curve: tuple[float, ...]


class Matcher:
    def __init__(self, stems: tuple[tuple[str, float], ...]) -> None:
        import ahocorasick

        self.weight = dict(stems)
        self.automaton = ahocorasick.Automaton()
        for stem in self.weight:
            self.automaton.add_word(stem.removesuffix(WHOLE), (stem, False))
        for phrase in EXCEPTIONS:
            self.automaton.add_word(phrase, (phrase, True))
        self.automaton.make_automaton()

    def hits(self, text: str) -> Counter:
        """How often each stem begins a word of a folded text, is that word, or, in a script
        without blanks, is anywhere, outside exception phrases; of stems that begin at the same
        place the longest counts."""
        at: dict[int, str] = {}
        excepted: list[tuple[int, int]] = []
        for end, (stem, exception) in self.automaton.iter(text):
            whole = stem.endswith(WHOLE)
            start = end - len(stem) + 1 + whole
            if start and text[start - 1].isalpha() and not _UNSPACED.match(stem):
                continue
            if whole and text[end + 1 : end + 2].isalpha():
                continue
            if exception:
                excepted.append((start, end))
            elif len(stem) > len(at.get(start, "")):
                at[start] = stem
        if excepted:
            at = {k: stem for k, stem in at.items() if not any(a <= k <= b for a, b in excepted)}
        return Counter(at.values())

    def measures(self, text: str) -> tuple[float, float, float]:
        """Weight of hits per hundred words, log of their weight, and log of the words."""
        clean = folded(text, self.weight)
        words = len(clean.split())
        weight = sum(self.weight[stem] * n for stem, n in self.hits(clean).items())
        return 100 * weight / (words + 10), math.log1p(weight), math.log1p(words)


@lru_cache(maxsize=1)
def matcher(stems: tuple[tuple[str, float], ...]) -> Matcher:
    return Matcher(stems)


def chance(measures: np.ndarray, curve: tuple[float, ...]) -> np.ndarray:
    """Chance of a toxic label; a text without hits gets that of such texts, whatever its length."""
    columns = _columns(measures)
    return 1 / (1 + np.exp(-np.clip(columns @ np.array(curve), -50, 50)))


def _columns(measures: np.ndarray) -> np.ndarray:
    measures = np.asarray(measures, float).reshape(-1, 3)
    hit = measures[:, 1] > 0
    density = np.log1p(measures[:, 0])
    return np.column_stack((np.ones(len(measures)), hit, density, measures[:, 1] * hit, measures[:, 2] * hit))


def labelled(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> tuple[DataFrame, dict[int, float]]:
    """(text, toxic, half) of at most about `rows` labelled documents per label, with the share
    of each label's rows that they are.

    A document with several labels counts as toxic if one says so; null ids and labels are
    left out, and so are held-out documents. The chosen ids are few, so texts do not move.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("labelled_id"), "toxic")
        .where("labelled_id IS NOT NULL AND toxic IS NOT NULL")
        .where(learnable(F.col("labelled_id"), HELD_MODULUS, HELD_RESIDUE))
        .groupBy("labelled_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    counts = {row["toxic"]: row["n"] for row in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {k: min(1.0, rows / n) for k, n in counts.items()}
    grain = 1 << 30
    limit = F.coalesce(*(F.when(F.col("toxic") == k, F.lit(int(x * grain))) for k, x in share.items()), F.lit(0))
    mark = F.pmod(F.xxhash64("labelled_id"), F.lit(grain))
    chosen = known.where(mark < limit).select("labelled_id", "toxic", (F.pmod(mark, F.lit(2)) == 0).alias("half"))
    joined = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").join(
        F.broadcast(chosen), F.col("doc") == F.col("labelled_id")
    )
    return staged(joined.select("text", "toxic", "half"), "labelled"), share


def stems_of(word: str) -> list[str]:
    """The stems that a word could be found by."""
    if len(word) in SHORT_CHARS and not _UNSPACED.match(word):
        return [word + WHOLE]
    runs = [run for run in _UNSPACED.findall(word)] if not word.isascii() else []
    inside = [run[k : k + size] for run in runs for size in RUN_CHARS for k in range(len(run) - size + 1)]
    if runs:
        return inside
    return [word[:size] for size in STEM_CHARS if size <= len(word)]


def stem_counts(sample: DataFrame) -> DataFrame:
    """(stem, toxic, docs, uses): what may become a stem, in texts of either label. A text counts
    at most 5 uses of a stem, so that no single text makes a stem."""

    def prepare() -> Callable[[pa.RecordBatch], dict[str, object]]:
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            docs, uses = Counter(), Counter()
            for text, toxic in zip(texts(batch.column(0)), batch.column(1).to_pylist()):
                mine: Counter = Counter()
                for word, n in Counter(_WORD.findall(folded(text))).items():
                    for stem in stems_of(word):
                        mine[stem] += n
                for stem, n in mine.items():
                    docs[stem, toxic] += 1
                    uses[stem, toxic] += min(n, 5)
            return {
                "stem": [stem for stem, _ in docs],
                "toxic": [toxic for _, toxic in docs],
                "docs": list(docs.values()),
                "uses": [uses[key] for key in docs],
            }

        return work

    made = batches(sample.select("text", "toxic"), "stem string, toxic int, docs long, uses long", prepare)
    return made.groupBy("stem", "toxic").agg(F.sum("docs").alias("docs"), F.sum("uses").alias("uses"))


def choose_stems(sample: DataFrame) -> tuple[tuple[str, float], ...]:
    """Seeds and the stems whose use differs most between the labels, with log ratios as weights.

    Of stems that begin alike the one that tells most is taken. Only stems in four or more
    toxic texts come to the driver, and of these those more frequent there than elsewhere.
    """
    counts = stem_counts(sample)
    size = {row["toxic"]: row["n"] for row in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    weights = dict(SEEDS)
    if toxic and clean:
        wide = counts.groupBy("stem").agg(
            *(
                F.coalesce(F.sum(F.when(F.col("toxic") == k, F.col(x))), F.lit(0)).alias(f"{x}{k}")
                for k in (0, 1)
                for x in ("docs", "uses")
            )
        )
        often = wide.where(f"docs1 >= 4 AND uses1 * {clean} > 3 * uses0 * {toxic}")
        found = [row.asDict() for row in often.collect()]
        weights |= pick(found, toxic, clean)
    return tuple(sorted(weights.items()))


def pick(found: list[dict], toxic: int, clean: int) -> dict[str, float]:
    def ratio(x: dict) -> float:
        return math.log((x["uses1"] + 0.5) / toxic / ((x["uses0"] + 0.5) / clean))

    def telling(x: dict) -> float:
        """Log-likelihood gain of separate rates over a common one."""
        a, b = x["uses1"], x["uses0"]
        common = (a + b) / (toxic + clean)
        gain = a * math.log(a / toxic / common) if a else 0.0
        return gain + (b * math.log(b / clean / common) if b else 0.0)

    lengths = range(RUN_CHARS.start, STEM_CHARS.stop)
    taken: dict[str, float] = {}
    related: dict[str, set[str]] = defaultdict(set)
    told = {x["stem"]: (telling(x), x) for x in found}
    for start in sorted(told, key=lambda stem: (-told[stem][0], stem)):
        gain = told[start][0]
        if gain < LEAST_GAIN:
            break
        if any(start[:k] in taken for k in lengths) or related[start]:
            continue
        # A longer stem that tells nearly as much is less likely to begin other words.
        alike = [stem for stem in told if stem.startswith(start) and told[stem][0] >= 0.95 * gain]
        stem = max(alike, key=lambda stem: (len(stem), told[stem][0], stem))
        x = told[stem][1]
        taken[stem] = min(ratio(x), 6.0)
        for k in lengths:
            related[stem[:k]].add(stem)
    return taken


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> Model:
    """Lexicon from one half of the labelled sample, curve from the other."""
    sample, share = labelled(docs, labels, rows)
    stems = choose_stems(sample.where("half"))

    def prepare() -> Callable[[pa.RecordBatch], dict[str, object]]:
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            found = [matcher(stems).measures(text) for text in texts(batch.column(0))]
            return {"measures": [list(x) for x in found], "toxic": batch.column(1)}

        return work

    other = sample.where("NOT half").select("text", "toxic")
    # In an order of their own, so that sums do not depend on how the rows lie in files.
    rows_of = sorted(batches(other, "measures array<double>, toxic int", prepare).collect())
    measures = np.array([row["measures"] for row in rows_of]).reshape(-1, 3)
    label = np.array([row["toxic"] for row in rows_of], float)
    weight = np.array([1 / share[row["toxic"]] for row in rows_of])
    return Model(stems, fit_curve(measures, label, weight))


DEFAULT_CURVE = (-4.0, 1.0, 1.5, 0.0, 0.0)


def fit_curve(measures: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton steps, drawn a little towards a curve chosen beforehand."""
    start = np.array(DEFAULT_CURVE)
    columns, curve = _columns(measures), start.copy()
    weight = weight / weight.mean() if len(weight) else weight
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(columns @ curve, -50, 50)))
        slope = columns.T @ (weight * (p - label)) + 0.1 * (curve - start)
        bend = (columns * (weight * p * (1 - p))[:, None]).T @ columns + 0.1 * np.eye(len(start))
        step = np.linalg.solve(bend, slope)
        curve = curve - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return tuple(curve.tolist())


RESULT = "doc_id long, held_out boolean, score double, predicted int"


def toxicity(
    docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS, threshold: float = THRESHOLD
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every input row.

    The score depends on the text alone. A null or empty text has no hit and gets the score of
    texts without hits. Without labels the seeds and a fixed curve stand. Repeated rows are
    scored each; a null id is never held out; other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))

    def prepare() -> Callable[[pa.RecordBatch], dict[str, object]]:
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            match = matcher(model.value.stems)
            found = np.array([match.measures(text) for text in texts(batch.column(2))]).reshape(-1, 3)
            score = chance(found, model.value.curve)
            return {
                "doc_id": batch.column(0),
                "held_out": batch.column(1),
                "score": score,
                "predicted": (score >= threshold).astype(np.int32),
            }

        return work

    held = is_residue(F.col("doc_id"), HELD_MODULUS, HELD_RESIDUE).alias("held")
    return batches(docs.select(F.col("doc_id").cast("long"), held, "text"), RESULT, prepare)
