"""Quality rules: counts per text, and perplexity under models of words and of letters within bands for each language."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleframe.llm.wordpairs import discounts, with_word_surprise
from ruleframe.llm.words import LOWER, SPACED, buffers, grams, hashes, pieces, spans
from ruleframe.session import stage

#: Fixed value: the characters that count as symbols.
SYMBOLS = b"#*$%&|<>"

#: Kinds of bytes that the model tells apart; as many to the power of its order bound its size.
LETTERS = 48
_PUNCTUATION = (b".!?", b",;:", b"'\"`", b"()[]{}", b"-_/\\", SYMBOLS)


def _letters() -> np.ndarray:
    """The letter of each byte: a-z in either case, digits, blanks, line ends, groups of punctuation, other ASCII
    characters, and twelve of bytes beyond ASCII, by their lowest bits: eight of those that continue a character
    and four of those that begin one."""
    letter = np.full(256, 35, np.uint8)
    byte = np.arange(256)
    letter[0x61:0x7B] = letter[0x41:0x5B] = np.arange(26)
    letter[0x30:0x3A] = 26
    letter[[0x20, 0x09, 0x0B, 0x0C]] = 27
    letter[[0x0A, 0x0D]] = 28
    for number, group in enumerate(_PUNCTUATION):
        letter[list(group)] = 29 + number
    letter[0x80:0xC0] = 36 + byte[0x80:0xC0] % 8
    letter[0xC0:] = 44 + byte[0xC0:] % 4
    return letter


LETTER = _letters()
LINE = 28  # what stands before a text


def grams_of(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """The number of the ``order`` letters that end at each byte, in base ``LETTERS``, oldest first; before a text
    there are line ends."""
    letter = LETTER[data]
    firsts = np.unique(offsets[:-1])
    out = np.zeros(len(data), np.int32)
    for back in range(order - 1, -1, -1):
        own = np.full(len(data), LINE, np.uint8)
        own[back:] = letter[: max(len(data) - back, 0)]
        for at in range(back):  # places that the text before would reach into
            near = firsts + at
            own[near[near < np.append(firsts[1:], len(data))]] = LINE
        out *= LETTERS
        out += own
    return out


def gram_counts(texts: DataFrame, order: int) -> DataFrame:
    """(gram, n) over all texts; each task adds up its own in one array of all grams there can be."""
    size = LETTERS**order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for whole in batches:
            for batch in pieces(whole, "text"):
                total += np.bincount(grams_of(*buffers(batch.column(0)), order), minlength=size)
        at = np.flatnonzero(total)
        for first in range(0, len(at), 50_000):
            part = at[first : first + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["gram", "n"])

    return texts.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _hash(numbers: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit numbers, so that no two grams of a model share a hash."""
    x = numbers.astype(np.uint32)
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        x = (x ^ (x >> np.uint32(shift))) * np.uint32(factor)
    return x ^ (x >> np.uint32(16))


@dataclass(frozen=True)
class Level:
    """Grams of one length: sorted hashes with log probabilities, and sorted hashes of histories with the log
    weight of the shorter history behind them."""

    hashes: np.ndarray
    chances: np.ndarray
    histories: np.ndarray
    weights: np.ndarray


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each wanted hash is there, and its value."""
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return keys[at] == wanted, values[at]


@dataclass(frozen=True)
class KneserNey:
    """An interpolated modified Kneser-Ney model; ``levels`` from single letters up."""

    order: int
    levels: tuple[Level, ...]

    @classmethod
    def of(cls, numbers: np.ndarray, counts: np.ndarray, order: int) -> KneserNey:
        """From the counts of the longest grams. Shorter ones count the letters that stand before them."""
        tables = [(numbers, counts.astype(np.int64))]
        for size in range(order - 1, 0, -1):
            longer = tables[0][0]
            tables.insert(0, tuple(np.unique(longer % LETTERS**size, return_counts=True)))
        levels: list[Level] = []
        for size, (own, count) in enumerate(tables, 1):
            taken = discounts([int((count == k).sum()) for k in (1, 2, 3, 4)])
            owner, which = np.unique(own // LETTERS, return_inverse=True)
            total = np.bincount(which, weights=count)
            less = taken[np.minimum(count, 3)]
            weight = np.bincount(which, weights=less) / total
            if size == 1:
                shorter = np.full(len(own), 1 / LETTERS)
            else:
                shorter = np.exp(cls(order, tuple(levels)).chances(own % LETTERS ** (size - 1), size - 1))
            chance = (count - less) / total[which] + weight[which] * shorter
            by, hby = np.argsort(_hash(own)), np.argsort(_hash(owner))
            levels.append(Level(
                _hash(own)[by], np.log(np.maximum(chance, 1e-300))[by], _hash(owner)[hby], np.log(np.maximum(weight, 1e-300))[hby],
            ))
        return cls(order, tuple(levels))

    def chances(self, numbers: np.ndarray, size: int | None = None) -> np.ndarray:
        """The log probability of the last letter of each gram of ``size`` letters."""
        size = self.order if size is None else size
        out = np.zeros(len(numbers))
        open_ = np.arange(len(numbers))
        for k in range(size, 0, -1):
            level, own = self.levels[k - 1], numbers[open_] % LETTERS**k
            there, chance = _looked_up(level.hashes, level.chances, _hash(own))
            out[open_[there]] += chance[there]
            open_, own = open_[~there], own[~there]
            if not len(open_):
                return out
            there, weight = _looked_up(level.histories, level.weights, _hash(own // LETTERS))
            out[open_[there]] += weight[there]
        out[open_] -= np.log(LETTERS)
        return out


def fit_quality(docs: DataFrame, *, text: str = "text", order: int = 4) -> KneserNey | None:
    """The model of all texts. Spark counts the grams; of these there are at most ``LETTERS ** order`` (5.3 million of
    four), so that the driver may hold them. None if there is no text."""
    found = gram_counts(docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")), order).orderBy("gram").toArrow()
    if not found.num_rows:
        return None
    return KneserNey.of(found["gram"].to_numpy(), found["n"].to_numpy(), order)


def _speller(shared: Broadcast) -> Callable:
    """In a task, the function that gives the log chance of the bytes of each word, lower-cased, and the blank behind them:
    that of their letters, evenly dealt among the bytes of each."""
    own = shared.value
    if own is None:  # no texts
        return lambda data, starts, ends: np.zeros(len(starts))
    kinds = np.maximum(np.bincount(LETTER[np.unique(LOWER)], minlength=LETTERS), 1)

    def spell(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        before = own.order - 1
        bounds = np.append(0, np.cumsum(ends - starts + before + 1))
        row = np.repeat(np.arange(len(starts)), ends - starts)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(ends - starts) - (ends - starts), ends - starts)
        spaced = np.full(bounds[-1], 0x20, np.uint8)
        spaced[bounds[row] + before + inside] = data[starts[row] + inside]
        found, at = np.unique(grams_of(spaced, bounds, own.order), return_inverse=True)
        chance = own.chances(found)[at] - np.log(kinds)[LETTER[spaced]]
        chance[np.add.outer(bounds[:-1], np.arange(before)).ravel()] = 0
        return _sums(chance, bounds)

    return spell


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of values[bounds[i]:bounds[i + 1]] for each i."""
    kind = np.float64 if values.dtype == np.float64 else np.int64
    out = np.zeros(len(bounds) - 1, kind)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        out[some] = np.add.reduceat(values, bounds[some], dtype=kind)
    return out


def text_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text of a buffer."""
    texts = len(offsets) - 1
    starts, ends = spans(data, offsets, SPACED)
    bounds = np.searchsorted(starts, offsets)
    word_owner = np.repeat(np.arange(texts), np.diff(bounds))
    begins = SPACED[data] & ((data & 0xC0) != 0x80)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    hashed = hashes(data, starts, ends)
    # Lines: from one line end or text start to the next
    edges = np.unique(np.concatenate([offsets, np.flatnonzero(data == 0x0A) + 1]))
    first, last = edges[:-1], edges[1:].copy()
    last -= (last > first) & (data[np.maximum(last - 1, 0)] == 0x0A) if len(data) else 0
    worded = np.searchsorted(starts, last) > np.searchsorted(starts, first)
    first, last = first[worded], last[worded]
    line_owner = np.searchsorted(offsets, first, "right") - 1
    line = hashes(data, first, last)
    line = grams(np.stack([line_owner.astype(np.uint64), line], axis=1).ravel(), 2)[::2]
    order = np.argsort(line, kind="stable")
    again = np.zeros(len(line), bool)
    again[1:] = line[order][1:] == line[order][:-1]
    # Windows of three words that occur again in the same text
    window = grams(hashed, 3)
    inside = np.flatnonzero(word_owner[: len(window)] == word_owner[2 : 2 + len(window)])
    window = grams(np.stack([word_owner[inside].astype(np.uint64), window[inside]], axis=1).ravel(), 2)[::2]
    sort = np.argsort(window)
    same = np.zeros(len(sort) + 1, bool)
    same[1:-1] = window[sort][1:] == window[sort][:-1]
    repeated = inside[sort[same[1:] | same[:-1]]]
    covered = np.zeros(len(hashed) + 3, bool)
    for k in range(3):
        covered[repeated + k] = True
    return {
        "n_words": np.diff(bounds), "word_chars": _sums(begins, offsets), "n_symbols": _sums(symbol[data], offsets),
        "n_dup_lines": np.bincount(line_owner[order][again], minlength=texts),
        "n_repeat_words": _sums(covered[: len(hashed)], bounds),
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _quality_type() -> T.StructType:
    return T.StructType([*(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("log_perplexity", T.DoubleType())])


def _counter(shared: Broadcast, at: int, name: str) -> Callable:
    """The function that adds the struct of ``with_quality`` to Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        known = np.full(LETTERS**own.order if own else 0, np.nan)  # each gram is searched for once in a task
        for whole in batches:
            for batch in pieces(whole, whole.schema.names[at]):
                data, offsets = buffers(batch.column(at))
                counts = text_counts(data, offsets)
                sizes = np.diff(offsets)
                if own:
                    found = grams_of(data, offsets, own.order)
                    new = np.unique(found[np.isnan(known[found])])
                    known[new] = own.chances(new)
                    total = _sums(known[found], offsets)
                else:
                    total = np.zeros(len(sizes))
                surprise = pa.array(-total / np.maximum(sizes, 1), pa.float64(), mask=sizes == 0)
                columns = [pa.array(counts[c].astype(np.int64)) for c in COUNTS] + [surprise]
                struct = pa.StructArray.from_arrays(columns, [*COUNTS, "log_perplexity"])
                yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, name])

    return run


def with_quality(docs: DataFrame, model: KneserNey | None, *, text: str = "text", name: str = "quality") -> DataFrame:
    """The documents with a struct: the counts of ``text_counts`` and ``log_perplexity``, the mean surprise per byte
    in nats, null for an empty text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select("*", F.lit(None).cast(_quality_type()).alias(name)).schema
    return docs.mapInArrow(_counter(shared, docs.columns.index(text), name), schema)


def perplexity_bands(scored: DataFrame, lang: str, surprise: str, *, reach: float, least: float) -> DataFrame:
    """(lang, low, high, wide): per language the quarters of the surprises, and ``reach`` times their distance, at least
    ``least``. Quarters come from counts of thousandths, which any number of rows may share."""
    steps = scored.where(F.col(surprise).isNotNull()).groupBy(F.col(lang).alias("lang"), F.floor(F.col(surprise) * 1000).alias("step")).agg(F.count("*").alias("n"))
    # As many rows per language as its surprises have thousandths, some ten thousand: a mean varies little over 50 words.
    by = Window.partitionBy("lang").orderBy("step")
    ranked = steps.withColumn("upto", F.sum("n").over(by)).withColumn("all", F.sum("n").over(Window.partitionBy("lang")))
    quarters = [F.min(F.when(4 * F.col("upto") >= k * F.col("all"), F.col("step") / 1000.0)) for k in (1, 3)]
    found = ranked.groupBy("lang").agg(quarters[0].alias("q1"), quarters[1].alias("q3"))
    wide = F.greatest(reach * (F.col("q3") - F.col("q1")), F.lit(least))
    return found.select("lang", F.col("q1").alias("low"), F.col("q3").alias("high"), wide.alias("wide"))


def quality_report(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", lang: str = "lang", order: int = 4, reach: float = 3.0,
    least: float = 0.02, short: int = 300, least_words: int = 50, most_repeated: float = 50.0, least_per_word: float = 0.1,
) -> DataFrame:
    """(id, lang, counts..., base_failed, log_perplexity, low, high, letter_perplexity, letter_low, letter_high, kept) of
    each document.

    Base rules: a text of fewer than ``least_words`` words, or of which more than ``most_repeated`` percent stand in
    runs of three words found twice or more in it, fails. The rest are judged by their perplexity under an interpolated
    modified Kneser-Ney model of the word pairs of all texts (``with_word_surprise``), however rare; a word's spelling
    stands below its single word, by a model of the same kind of runs of ``order`` letters, whose number is bounded
    by the ``LETTERS`` kinds of letters, so that every task may hold it. ``log_perplexity`` is the mean surprise per
    word, the end of the text among them, and ``letter_perplexity`` that of the letter model alone per byte, in nats.
    For each language and either one a band is laid around the middle half of the texts that pass the base rules:
    ``reach`` times that half's width to either side, at least ``least_per_word`` nats a word or ``least`` a byte, and
    wider for a text of b bytes by the root of 1 + ``short`` / b, as short texts vary more. Texts above either band (noise)
    or below that of the letters (patter) are rejected. Below that of the words a text is not rejected for it: copies
    and passages that other texts have as well lower its surprise, whatever their quality.

    Null and empty texts have no words, fail, and have no perplexity. A null language is one of its own; rows that
    repeat count each; null ids are kept; an empty table gives no rows. Other columns of the table play no part.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    model = fit_quality(rows, order=order)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = rows.withColumn("bytes", F.octet_length("text"))
    added = (T.StructField("quality", _quality_type()),)
    judged = with_word_surprise(rows, partial(_speller, shared), name="words", added=added, add=_counter(shared, rows.columns.index("text"), "quality"))
    judged = judged.select("id", "lang", "bytes", "words", "quality.*").withColumnRenamed("log_perplexity", "letter_perplexity")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    judged = judged.withColumns({"base_failed": failed, "log_perplexity": F.when(F.col("bytes") > 0, F.col("words"))}).drop("words")
    passed, kept = judged.where("NOT base_failed"), ~F.col("base_failed")
    for value, width, low, high in (("log_perplexity", least_per_word, "low", "high"), ("letter_perplexity", least, "letter_low", "letter_high")):
        bands = stage(perplexity_bands(passed, "lang", value, reach=reach, least=width), "bands").toDF("of", low, high, "wide")
        judged = judged.join(bands, F.col("lang").eqNullSafe(F.col("of")), "left")
        wide = F.col("wide") * F.sqrt(1 + short / F.greatest("bytes", F.lit(1)))
        judged = judged.withColumns({low: F.col(low) - wide, high: F.col(high) + wide}).drop("of", "wide")
        least_kept = F.col(low) if value == "letter_perplexity" else F.lit(0.0)
        kept = kept & F.coalesce(F.col(value).between(least_kept, F.col(high)), F.lit(False))
    return judged.withColumn("kept", kept).drop("bytes")
