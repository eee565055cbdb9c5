"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ruleframe.llm.words import trimmed

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i",
    "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g",
}
#: Digits and signs that stand for letters; l and i fold together, as 1 stands for both.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i"}
INVISIBLE = "­​‌‍⁠﻿"
#: Phrases in which a word of the lexicon is meant literally.
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "clown fish", "circus clown", "pond scum", "loser bracket",
    "disgusting taste", "worthless currency", "pathetic fallacy",
)

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_ASCII = bytes(
    ord({**DIGITS, **{c: c for c in _LETTERS}, "l": "i"}.get(chr(b).lower(), " ")) for b in range(128)
) + bytes(range(128, 256))
_SIGN = re.compile(r"[@$](?=[A-Za-z])|(?<=[A-Za-z0-9])[@$!|](?=[A-Za-z0-9])")


class _Fold(dict):
    """Translation of one code point, worked out once for each that occurs."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if c in INVISIBLE:
            out = ""
        elif code < 128:
            out = chr(_ASCII[code])
        elif 0xFF01 <= code <= 0xFF5E:  # full-width forms
            out = chr(_ASCII[code - 0xFEE0])
        else:
            low = HOMOGLYPHS.get(c.lower(), c.lower())
            out = low if low.isalnum() else " "
        self[code] = out
        return out


_FOLD = _Fold()


def fold(text: str) -> str:
    """Lower case, look-alike letters, digits and signs as letters, anything else a blank."""
    if "@" in text or "$" in text or "!" in text or "|" in text:
        text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    if text.isascii():
        return text.encode().translate(_ASCII).decode()
    return text.translate(_FOLD)


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of folded words, phrases that excuse them, and the three numbers of a logistic curve."""

    lexicon: dict[str, float]
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)
    exceptions: tuple[str, ...] = EXCEPTIONS
    _automaton: list = field(default_factory=list, compare=False, repr=False)

    def __getstate__(self):
        return {"lexicon": self.lexicon, "curve": self.curve, "exceptions": self.exceptions, "_automaton": []}

    def automaton(self):
        if not self._automaton:
            made = ahocorasick.Automaton()
            for phrase in self.exceptions:
                made.add_word(f" {' '.join(fold(phrase).split())} ", (len(" ".join(fold(phrase).split())) + 2, 0.0))
            for word, weight in self.lexicon.items():
                made.add_word(f" {word} ", (len(word) + 2, weight))
            made.make_automaton()
            self._automaton.append(made)
        return self._automaton[0]

    def features(self, text: str | None) -> tuple[float, float]:
        """Weight of all matches, and the same for a hundred words, both as log(1 + x)."""
        words = fold(text or "").split()
        if not self.lexicon or not words:
            return 0.0, 0.0
        hits, excused = [], []
        for last, (size, weight) in self.automaton().iter(f" {' '.join(words)} "):
            (hits if weight else excused).append((last - size + 1, last, weight))
        if excused:
            hits = _outside(hits, excused)
        total = sum(h[2] for h in hits)
        return math.log1p(total), math.log1p(100 * total / len(words))

    def score(self, text: str | None) -> float:
        a, b, c = self.curve
        x, y = self.features(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x + c * y))))


def _outside(hits: list[tuple], phrases: list[tuple]) -> list[tuple]:
    """The hits that lie in no phrase. Both are in order of their ends; from the back, the earliest start
    of the phrases that end at a hit's end or later tells whether one of them covers it."""
    kept, start, i = [], math.inf, len(phrases) - 1
    for hit in reversed(hits):
        while i >= 0 and phrases[i][1] >= hit[1]:
            start = min(start, phrases[i][0])
            i -= 1
        if hit[0] < start:
            kept.append(hit)
    return kept[::-1]


#: Word hashes that have to agree for two training texts to count as one; texts that share half their words
#: do so once in two to the power of this.
SKETCH = 16


def _sketch(words: list[str]) -> int:
    """Nearly equal texts mostly share it, others do not: the smallest word hash under each of ``SKETCH`` seeds."""
    return hash(tuple(min(xxhash.xxh32_intdigest(w, seed) for w in words) for seed in range(1, SKETCH + 1)))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, train: Column | None = None, *, id: str = "doc_id", text: str = "text",
    label: str = "toxic", sample: int = 20_000, level: float = 0.05, exceptions: tuple = EXCEPTIONS,
) -> ToxicityModel:
    """Learn a lexicon and its curve from labelled documents.

    At most ``sample`` labelled ids for which ``train`` (over the label table) holds are used, those
    with the smallest hash, so that everything fitted is bounded. A word enters the lexicon if it is so
    much more frequent in documents with label 1 that chance explains none of all words at ``level``
    (Chernoff bound, corrected for the number of words); its weight is its log-odds. Nearly equal
    documents of one label count once, so that a group of copies does not make its words suspicious. All words
    that pass the test are kept; the sample bounds them. Ids with contrary labels take the more frequent one, ties 1; null ids
    and labels are left out. With no usable labels the lexicon is empty and every score 0.5.
    """
    usable = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull())
    if train is not None:
        usable = usable.where(train)
    chosen = (
        usable.groupBy(F.col(id).alias("id")).agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id").limit(sample)
    )
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")  # ``sample`` rows

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches, toxic, lists = [], [], []
            for body, y in zip(batch.column(0), batch.column(1)):
                words = list(dict.fromkeys(fold(body.as_py() or "").split()))
                if words:
                    sketches.append(_sketch(words))
                    toxic.append(y.as_py())
                    lists.append(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sketches, pa.int64()), pa.array(toxic, pa.int32()), pa.array(lists, pa.list_(pa.string()))],
                ["sketch", "toxic", "words"],
            )

    bags = texts.select("text", "toxic").mapInArrow(trimmed(words_of), "sketch long, toxic int, words array<string>")
    groups = bags.groupBy("sketch", "toxic").agg(F.max("words").alias("words")).select("toxic", "words")
    groups = groups.persist()
    try:
        size = groups.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
        if not size.toxic or size.toxic == size.n:
            return ToxicityModel({}, exceptions=exceptions)
        counted = groups.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
            F.sum("toxic").alias("t"), F.count("*").alias("n")
        )
        prior = size.toxic / size.n
        share = F.col("t") / F.col("n")
        gain = F.col("t") * F.log(share / prior) + F.when(
            F.col("t") < F.col("n"), (F.col("n") - F.col("t")) * F.log((1 - share) / (1 - prior))
        ).otherwise(0.0)
        weight = F.log((F.col("t") + 0.5) / (size.toxic + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (size.n - size.toxic + 1))
        tested = counted.agg(F.count("*")).first()[0]
        rows = (
            counted.where(share > prior).select("word", gain.alias("gain"), weight.alias("weight"))
            .where(F.col("gain") >= math.log(max(tested, 1) / level)).where("weight > 1")
            .collect()
        )
    finally:
        groups.unpersist()
    model = ToxicityModel({r.word: r.weight for r in rows}, exceptions=exceptions)
    return ToxicityModel(model.lexicon, _curve(texts, model), exceptions)


def _curve(texts: DataFrame, model: ToxicityModel) -> tuple[float, float, float]:
    """Logistic regression on the two features, by Newton's method on at most ``sample`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [model.features(t.as_py()) for t in batch.column(0)]
            x, y = zip(*pairs) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), pa.array(y, pa.float64()), batch.column(1)], ["x", "y", "toxic"])

    rows = texts.select("text", "toxic").mapInArrow(trimmed(run), "x double, y double, toxic int").groupBy("x", "y", "toxic").count().orderBy("x", "y", "toxic").collect()
    if not rows:
        return 0.0, 0.0, 0.0
    data = np.array([(1.0, r.x, r.y) for r in rows])
    target = np.array([float(r.toxic) for r in rows])
    times = np.array([float(r["count"]) for r in rows])
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(data @ beta, -30, 30)))
        slope = data.T @ (times * (target - p)) - 0.01 * beta
        bend = (data * (times * p * (1 - p))[:, None]).T @ data + 0.01 * np.eye(3)
        step = np.linalg.solve(bend, slope)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, beta))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with one more column, the score from 0 to 1. Nothing is shuffled.

    Null and empty texts score as texts without a match; a column called ``name`` is replaced.
    """
    schema = StructType([f for f in docs.schema if f.name != name] + [StructField(name, DoubleType())])
    docs = docs.drop(name)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t.as_py()) for t in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(trimmed(run), schema)
