"""Importance resampling: documents drawn by how much more their n-grams occur in a target corpus."""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from ruleframe.llm.words import LOWER, pieces
from ruleframe.session import fresh_path, stage

#: Fixed value: what counts as a word of a text in lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Fixed value: bits of a row's number in a task, below the task's, in Spark's increasing ids.
TASK_BITS = 33
#: Stretches of text whose words a task keeps in mind; others are split again.
MEMORY = 1 << 18


def splitter() -> pre_tokenizers.PreTokenizer:
    """Words with their offsets; nothing about it is trained."""
    return pre_tokenizers.Split(Regex(WORD), "removed", invert=True)


class _Stretches(dict):
    """Checksum and length, in UTF-8, of the words of stretches of text between blanks, which no word crosses: split
    once each while they are held."""

    def __init__(self):
        self.split = splitter()

    def __missing__(self, stretch: str) -> tuple[int, ...]:
        found: tuple[int, ...] = ()
        for _, (first, last) in self.split.pre_tokenize_str(stretch):
            body = stretch[first:last].encode()
            found += zlib.crc32(body), len(body)
        if len(self) < MEMORY:
            self[stretch] = found
        return found


def _zeros_table() -> np.ndarray:
    """CRC registers after each byte value: the usual table of the reflected polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = _zeros_table()


class _Behind:
    """Checksums of texts that follow one another: crc(a + b) = shift(crc(a), len(b)) ^ crc(b), and the shift over
    zero bytes is linear, so one table of 4 x 256 entries per length does it for all rows."""

    def __init__(self):
        self.tables: dict[int, np.ndarray] = {}

    def _table(self, length: int) -> np.ndarray:
        if length not in self.tables:
            bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
            for _ in range(length):
                bits = (bits >> 8) ^ _TABLE[bits & 255]
            table = np.zeros((4, 256), np.uint32)
            for byte in range(4):
                for bit in range(8):
                    has = (np.arange(256) >> bit & 1).astype(bool)
                    table[byte, has] ^= bits[8 * byte + bit]
            if length > 64:
                return table
            self.tables[length] = table
        return self.tables[length]

    def join(self, first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The checksums of a + b from those of a and b; ``lengths`` are those of b."""
        most = int(lengths.max(initial=0))
        known = np.arange(min(most, 64) + 1)
        tables = np.stack([self._table(int(i)) for i in known])
        at = np.minimum(lengths, 64)
        out = second.copy()
        for byte in range(4):
            out ^= tables[at, byte, (first >> np.uint32(8 * byte)) & np.uint32(255)]
        for i in np.flatnonzero(lengths > 64):
            table = self._table(int(lengths[i]))
            out[i] = second[i] ^ np.bitwise_xor.reduce([table[b, int(first[i]) >> 8 * b & 255] for b in range(4)])
        return out


class Buckets:
    """The buckets of all runs of up to ``longest`` words of texts."""

    def __init__(self, longest: int, count: int):
        self.longest, self.count = longest, count
        self.stretches, self.behind = _Stretches(), _Behind()
        self.blank = np.uint32(zlib.crc32(b" "))

    def windows(self, text: str) -> list[np.ndarray]:
        """Buckets of the runs of 1, 2, ... words of a text. A window is a pair of words, the first and the last of a
        run, with one blank for whatever stands between two words."""
        numbers = itertools.chain.from_iterable(map(self.stretches.__getitem__, text.split(" ")))
        flat = np.fromiter(numbers, np.int64).reshape(-1, 2)
        crc, lengths = flat[:, 0].astype(np.uint32), flat[:, 1]
        kind = np.min_scalar_type(self.count - 1)
        found = [(crc % np.uint32(self.count)).astype(kind)]
        after_blank = self.behind.join(np.full(len(crc), self.blank, np.uint32), crc, lengths)
        window = crc
        for size in range(2, self.longest + 1):
            window = self.behind.join(window[:-1], after_blank[size - 1 :], lengths[size - 1 :] + 1)
            found.append((window % np.uint32(self.count)).astype(kind))
            if not len(window):
                break
        return found


def _lowered(batch: pa.RecordBatch, column: str) -> list[str]:
    """Texts with A-Z in lower case and nothing else changed."""
    texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    data = LOWER[np.frombuffer(data, np.uint8)] if data is not None else np.zeros(0, np.uint8)
    return pa.LargeStringArray.from_buffers(len(texts), offsets, pa.py_buffer(data.tobytes()), None, 0, texts.offset).to_pylist()


def with_buckets(docs: DataFrame, *, id: str = "doc_id", text: str = "text", longest: int = 3, buckets: int = 10_000) -> DataFrame:
    """(id, n_words, features): the buckets of all runs of words of each document, in the fewest bytes each."""
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Buckets(longest, buckets)
        for whole in batches:
            for batch in pieces(whole, "text"):
                found = [hashed.windows(body) for body in _lowered(batch, "text")]
                words = pa.array([len(f[0]) for f in found], pa.int64())
                bodies = pa.array([np.concatenate(f).tobytes() for f in found], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("id"), words, bodies], ["id", "n_words", "features"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_words long, features binary")


def bucket_counts(hashed: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n): how many runs of words of all texts fall into each bucket that holds any. Every task adds up
    its own texts first."""
    kind = np.min_scalar_type(buckets - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for body in batch.column("features"):
                total += np.bincount(np.frombuffer(body.as_buffer(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    return hashed.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of each of the B buckets, from its counts s and t of S and T."""
    b = F.lit(buckets)
    all_buckets = source.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    s, t = source.withColumnRenamed("n", "s"), target.withColumnRenamed("n", "t")
    both = all_buckets.join(s, "bucket", "left").join(t, "bucket", "left").fillna(0, ["s", "t"])
    sums = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t")).first()
    ratio = (F.col("t").cast("double") + 1) * (F.lit(float(sums["all_s"])) + b) / ((F.col("s").cast("double") + 1) * (F.lit(float(sums["all_t"])) + b))
    gains = both.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain")).orderBy("bucket").toArrow()
    return gains["gain"].to_numpy().astype(np.int64)


def with_weights(hashed: DataFrame, gains: np.ndarray) -> DataFrame:
    """(id, n_words, n_features, weight): the gains of all runs of words of each document, added up."""
    kind = hashed.schema["id"].dataType.simpleString()
    narrow = np.min_scalar_type(len(gains) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(body.as_buffer(), narrow) for body in batch.column("features")]
            sums = [pa.array([len(f) for f in found], pa.int64()), pa.array([int(gains[f].sum()) for f in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_words"), *sums], ["id", "n_words", "n_features", "weight"])

    return hashed.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def _stored(hashed: DataFrame) -> DataFrame:
    """Written to the shared folder; buckets do not repeat as whole values."""
    path, schema = fresh_path(hashed.sparkSession, "buckets"), hashed.schema
    hashed.write.option("parquet.enable.dictionary", "false").parquet(path)
    return hashed.sparkSession.read.schema(schema).parquet(path)


def noise(id: Column, seed: int) -> Column:
    """A draw from the Gumbel distribution, in thousandths, fixed by the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _numbered(ordered: DataFrame) -> DataFrame:
    """The rows of a sorted table with their ``number`` from 1. Every task of the sort numbers its own rows before they are
    written, for files are read in another order; one row per task says how many stand before it."""
    rows = stage(ordered.withColumn("at", F.monotonically_increasing_id()), "ranked")
    task = F.shiftright("at", TASK_BITS)
    counts = rows.groupBy(task.alias("of")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("of", F.coalesce(before, F.lit(0)).alias("before"))
    joined = rows.join(F.broadcast(starts), task == F.col("of"))  # one row per task
    inside = F.col("at").bitwiseAND(F.lit((1 << TASK_BITS) - 1))
    return joined.withColumn("number", F.col("before") + inside + 1).drop("of", "before", "at")


def importance_resample(
    docs: DataFrame, target: DataFrame, *, id: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = 3,
    buckets: int = 10_000, percent: int = 5, least_words: int = 20, seed: int = 42,
) -> DataFrame:
    """(id, n_features, weight, score, rank) of each document; ``rank`` numbers those that are drawn.

    Texts are lower-cased in A-Z and split into words with offsets; all runs of 1 to ``longest`` words are
    features, counted in ``buckets`` by their checksums, over all documents and over the target. A document's
    weight is the sum of its features' gains, its score adds Gumbel noise that its id fixes, and the highest
    ``percent`` of the documents with ``least_words`` words are drawn, without replacement: ties go to the smaller id.
    The texts are split once; their buckets, two bytes for a feature, are written to the shared folder and read for
    the counts and for the sums. The driver sees one number per bucket. Ranks come from a distributed sort of the ids
    and scores, whose equal rows are told apart by their place, so that no key is too large for a task.

    Null and empty texts have no features, weight 0 and no rank. A null id draws noise as an empty one, is drawn after
    other ids of the same score, and stays null. Rows that repeat count, and may be drawn, each. An empty
    table of documents gives no rows; an empty target gives every bucket its smoothed gain.
    """
    hashed = _stored(with_buckets(docs, id=id, text=text, longest=longest, buckets=buckets))
    items = target.select(F.lit(0).alias("id"), F.col(target_text).alias("text"))
    source = bucket_counts(hashed, buckets)
    wanted = bucket_counts(with_buckets(items, id="id", longest=longest, buckets=buckets), buckets)
    gains = bucket_gains(stage(source, "source"), stage(wanted, "target"), buckets)
    weighed = with_weights(hashed, gains).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    scored = stage(weighed.withColumn("place", F.monotonically_increasing_id()), "scores")
    eligible = F.col("n_words") >= least_words
    drawn = scored.where(eligible).count() * percent // 100
    order = [eligible.desc(), F.desc("score"), F.asc_nulls_last("id"), F.asc("place")]
    numbered = _numbered(scored.orderBy(*order))
    return numbered.select("id", "n_features", "weight", "score", F.when(F.col("number") <= drawn, F.col("number")).alias("rank"))
