"""Language-model scores by a weighted backoff automaton over word n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleframe.llm.words import LOWER, SPACED, buffers, hashes, mix, pieces, signed, spans
from ruleframe.session import fresh_path, session_settings, stage

#: The hash of the token that ends every text.
END = np.uint64(0x656E64)
#: Tokens of a chunk: texts that share one dictionary and are scored together.
CHUNK = 1 << 18
#: Tokens of a lane: longer texts go through the automaton in several, side by side.
LANE = 64
#: Shuffled files go when the query that needed them has ended, so that a level's requests do not outlive its answers.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Histories of at least this share of all training tokens are dealt out with the words that follow them.
HOT = 2e-4


@dataclass(frozen=True)
class Unigrams:
    """The empty history: counts of all training texts."""

    tokens: int
    distinct: int
    discount: float

    def chances(self, counts: np.ndarray) -> np.ndarray:
        """Probabilities by absolute discounting; what it takes off goes to unseen words."""
        if not self.tokens:
            return np.ones(len(counts))
        unseen = self.discount * self.distinct / self.tokens
        return np.where(counts > 0, (counts - self.discount) / self.tokens, unseen)


@dataclass(frozen=True)
class Level:
    """How the n-grams of ``size`` words are dealt out. ``hot`` holds the frequent histories, sorted, and
    ``sums`` what follows them that is kept: its count and its kinds."""

    size: int
    buckets: int
    hot: np.ndarray
    sums: np.ndarray


def _planes(numbers: np.ndarray, kind: str = "<i4") -> bytes:
    """First the lowest bytes of all numbers, then the next: high bytes are nearly all zero and compress."""
    numbers = np.ascontiguousarray(numbers, kind)
    return numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def _packed(planes: bytes) -> bytes:
    return len(planes).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(body: pa.Scalar, kind: str) -> np.ndarray:
    body = memoryview(body.as_buffer())
    planes = np.frombuffer(pa.decompress(body[8:], int.from_bytes(body[:8], "little"), "zstd"), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return planes.T.copy().view(kind).ravel()


def _write(*parts: DataFrame) -> tuple[DataFrame, str]:
    """Chunks in the shared folder, in small row groups: each row holds megabytes. Also the path. Several parts are
    written one after the other, so that what one shuffles is gone before the next begins."""
    spark, schema = parts[0].sparkSession, parts[0].schema
    path = fresh_path(spark, "chunks")
    options = {"parquet.block.size": 16 << 20, "parquet.enable.dictionary": "false", "compression": "zstd"}
    for rows in parts:
        rows.write.options(**options).mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path), path


def _delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


CHUNK_COLUMNS = ("chunk", "ids", "train", "sizes", "tokens", "vocabulary", "counts", "levels")


def _chunk_schema(kind: str) -> str:
    return (
        f"chunk long, ids array<{kind}>, train binary, sizes binary, tokens binary, vocabulary binary, counts binary, "
        "levels array<binary>"
    )


def chunks(docs: DataFrame, size: int = CHUNK) -> DataFrame:
    """One row for about ``size`` tokens of (id, train, text): the ids, the tokens as numbers, and the
    dictionary behind them with the counts in training texts, its own ones at first; levels come later."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        count = 0

        def flush():
            nonlocal held, count, number
            ids = pa.concat_arrays([h[0] for h in held])
            train = np.concatenate([h[1] for h in held])
            sizes = np.concatenate([h[2] for h in held])
            words = np.concatenate([h[3] for h in held])
            vocabulary, token, times = np.unique(words, return_inverse=True, return_counts=True)
            order = np.argsort(-times, kind="stable")  # frequent words get small numbers, which compress
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            token, vocabulary = place[token], vocabulary[order]
            learned = np.bincount(token[np.repeat(train, sizes)], minlength=len(vocabulary))
            columns = [
                pa.array([task << 32 | number]), pa.array([ids.to_pylist()], pa.list_(ids.type)), pa.array([train.tobytes()]),
                pa.array([sizes.astype(np.int64).tobytes()]), pa.array([_packed(_planes(token))]), pa.array([vocabulary.tobytes()]),
                pa.array([_packed(_planes(learned, "<i8"))]), pa.array([[]], pa.list_(pa.binary())),
            ]
            held, count = [], 0
            number += 1
            return pa.RecordBatch.from_arrays(columns, [*CHUNK_COLUMNS])

        for whole in batches:
            for batch in pieces(whole, "text"):
                data, offsets = buffers(batch.column(2))
                data = LOWER[data]
                starts, ends = spans(data, offsets, SPACED)
                bounds = np.searchsorted(starts, offsets)
                words = np.insert(hashes(data, starts, ends), bounds[1:], END)
                held.append((batch.column(0), batch.column(1).to_numpy(zero_copy_only=False).astype(bool), np.diff(bounds) + 1, words))
                count += len(words)
                if count >= size:
                    yield flush()
        if held:
            yield flush()

    return docs.select("id", "train", "text").mapInArrow(
        run,
        _chunk_schema(kind),
    )


def _rows(columns: dict[str, list], **one) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    arrays = [pa.array(v, pa.binary()) if k not in ("bucket",) else pa.array(v) for k, v in columns.items()]
    return pa.RecordBatch.from_arrays([*arrays, *(pa.array(np.full(size, v)) for v in one.values())], [*columns, *one])


def _cuts(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, first, end) of each run of a sorted array."""
    numbers, firsts = np.unique(bucket, return_index=True)
    return list(zip(numbers.tolist(), firsts.tolist(), [*firsts[1:].tolist(), len(bucket)]))


def _stable(bucket: np.ndarray, buckets: int) -> np.ndarray:
    """The order of rows by bucket, else as they are; small numbers are sorted by their digits."""
    return np.argsort(bucket.astype(np.min_scalar_type(max(buckets - 1, 0))), kind="stable")


def _by_bucket(words: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of words by bucket and hash, and their buckets in that order."""
    bucket = (mix(words) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(words)
    order = order[_stable(bucket[order], buckets)]
    return order, bucket[order]


def _count_words(parts: DataFrame, buckets: int) -> DataFrame:
    """The counts of all words over all chunks: for each chunk and bucket a row, packed in the order of
    :func:`_by_bucket`; for each bucket a row of totals (tokens, distinct, once, twice); and the words that
    occur often, named with their counts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = np.frombuffer(batch.column(1)[i].as_buffer(), np.uint64)
                n = _unpacked(batch.column(2)[i], "<i8")
                order, bucket = _by_bucket(words, buckets)
                words, n, cuts = words[order], n[order], _cuts(bucket)
                yield _rows({
                    "bucket": [k for k, _, _ in cuts],
                    "word": [_packed(_planes(np.diff(words[a:b], prepend=np.uint64(0)), "<u8")) for _, a, b in cuts],
                    "n": [_packed(_planes(n[a:b], "<i8")) for _, a, b in cuts],
                }, chunk=batch.column(0)[i].as_py())

    def count(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        asked = [np.cumsum(_unpacked(x, "<u8"), dtype=np.uint64) for x in rows["word"]]
        n = np.concatenate([_unpacked(x, "<i8") for x in rows["n"]])
        words, which = np.unique(np.concatenate(asked), return_inverse=True)
        c = np.bincount(which, weights=n, minlength=len(words)).astype(np.int64)
        ends = np.cumsum([len(x) for x in asked])
        found = c[which]
        totals = [int(c.sum()), int((c > 0).sum()), int((c == 1).sum()), int((c == 2).sum())]
        # In a bucket no more than 1 / HOT words can be frequent, and there are as many buckets as chunks at least.
        often = np.flatnonzero(c >= max(2, HOT * totals[0]))
        k, f = len(asked), len(often)
        return pa.table({
            "chunk": pa.concat_arrays([rows["chunk"].combine_chunks(), pa.nulls(1 + f, pa.int64())]),
            "bucket": pa.array(np.full(k + 1 + f, rows["bucket"][0].as_py())),
            "body": pa.array([_packed(_planes(found[e - len(x) : e], "<i8")) for x, e in zip(asked, ends)] + [None] * (1 + f), pa.binary()),
            "name": pa.concat_arrays([pa.nulls(k + 1, pa.int64()), pa.array(signed(words[often]))]),
            "totals": pa.array([None] * k + [totals] + [[int(x)] for x in c[often]], pa.list_(pa.int64())),
        })

    asked = parts.select("chunk", "vocabulary", "counts").mapInArrow(ask, "bucket long, word binary, n binary, chunk long")
    return asked.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(count, "chunk long, bucket long, body binary, name long, totals array<long>")


def _longer(history: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """The hash of a history and the word behind it."""
    return mix(history * np.uint64(0xD6E8FEB86659FD93) + tag)


def _places(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The place of each value, or -1."""
    if not len(sorted_values):
        return np.full(len(values), -1, np.int64)
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return np.where(sorted_values[at] == values, at, -1)


class Chunk:
    """A chunk with the n-grams it knows to be kept, level by level.

    The kept grams of ``size`` words are numbered by ``keys[size]``, sorted: the number of the gram without its last
    word, times the size of the dictionary, plus that word. Every word is kept. ``hashes[size]`` are the same
    in all chunks.
    """

    def __init__(self, row: dict[str, pa.Scalar]):
        self.row = row
        self.train, self.sizes, self.vocabulary = (
            np.frombuffer(row[c].as_buffer(), t) for c, t in (("train", bool), ("sizes", np.int64), ("vocabulary", np.uint64))
        )
        tokens, counts = _unpacked(row["tokens"], "<i4"), _unpacked(row["counts"], "<i8")
        self.words = len(self.vocabulary)
        firsts = np.cumsum(self.sizes) - self.sizes
        end = int(np.flatnonzero(self.vocabulary == END)[0])
        self.sequence = np.insert(tokens, firsts, end).astype(np.int64)  # before its first token a text has an end
        self.pad = np.zeros(len(self.sequence), bool)
        self.pad[firsts + np.arange(len(firsts))] = True
        self.learned = np.repeat(self.train, self.sizes + 1)
        self.tags = mix(self.vocabulary) >> np.uint64(24)
        self.keys: list[np.ndarray] = [None, np.arange(self.words)]
        self.counts: list[np.ndarray] = [None, counts]
        self.hashes: list[np.ndarray] = [None, self.vocabulary]
        self._at: list[np.ndarray | None] = [None, self.sequence]
        self.follow: list[np.ndarray] = [None]  # of each kept gram, what follows it that is kept: count and kinds
        bodies = [] if row["levels"].as_py() is None else list(row["levels"])
        for first in range(0, len(bodies), 3):
            keys = np.cumsum(_unpacked(bodies[first], "<i8"))
            self._add(keys, _unpacked(bodies[first + 1], "<i8"), _unpacked(bodies[first + 2], "<i8").reshape(2, -1))

    def _add(self, keys: np.ndarray, counts: np.ndarray, follow: np.ndarray) -> None:
        history, word = keys // self.words, keys % self.words
        self.follow.append(follow)
        self.hashes.append(_longer(self.hashes[-1][history], self.tags[word]))
        self.keys.append(keys)
        self.counts.append(counts)
        self._at.append(None)

    def at(self, size: int) -> np.ndarray:
        """The number of the kept gram of ``size`` words that ends at each place, or -1."""
        if self._at[size] is None:
            shorter = self.at(size - 1)
            found = np.full(len(self.sequence), -1, np.int64)
            place = np.flatnonzero(~self.pad & (np.append(-1, shorter[:-1]) >= 0))
            found[place] = _places(self.keys[size], shorter[place - 1] * self.words + self.sequence[place])
            self._at[size] = found
        return self._at[size]

    def levels(self) -> list[bytes]:
        return [
            _packed(_planes(x, "<i8"))
            for keys, counts, follow in zip(self.keys[2:], self.counts[2:], self.follow[1:])
            for x in (np.diff(keys, prepend=0), counts, follow.ravel())
        ]

    def asked(self, level: Level):
        """What has to be asked on a level: grams whose parts, without the last and without the first word, are both
        kept, for others cannot be, and the histories of all. Sorted by bucket, history and tag:
        (bucket, hash of the history, its number, its tag, key or -1, count in own training texts)."""
        ends = self.at(len(self.keys) - 1)
        before = np.append(-1, ends[:-1])
        valid = ~self.pad & (before >= 0)
        fit = np.flatnonzero(valid & (ends >= 0) if level.size > 2 else valid)
        key = before[fit] * self.words + self.sequence[fit]
        order = np.argsort(key)
        key, learned = key[order], self.learned[fit][order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        key = key[first]
        n = np.add.reduceat(learned.astype(np.int64), first) if len(first) else first
        history, word = key // self.words, key % self.words
        mark = np.zeros(len(self.keys[-1]), bool)
        mark[before[valid]] = True
        mark[history] = False
        alone = np.flatnonzero(mark)
        hashes = self.hashes[-1]
        hot = _places(level.hot, hashes) >= 0
        alone = alone[~hot[alone]]
        # Where a history and the words behind it go: one place for all, but for hot ones, whose words are dealt out.
        bucket = (mix(hashes ^ np.uint64(level.size)) % np.uint64(level.buckets)).astype(np.int64)
        gram_bucket = bucket[history]
        dealt = hot[history]
        own = _longer(hashes[history[dealt]], self.tags[word[dealt]])
        gram_bucket[dealt] = (own % np.uint64(level.buckets)).astype(np.int64)
        rank = np.empty(self.words, np.int64)  # of a word among all by its tag
        rank[np.argsort(self.tags)] = np.arange(self.words)
        by_hash = np.empty(len(hashes), np.int64)
        by_hash[np.argsort(hashes)] = np.arange(len(hashes))
        none = np.full(len(alone), -1, np.int64)
        gram_bucket, history = np.concatenate([gram_bucket, bucket[alone]]), np.concatenate([history, alone])
        ranked = np.concatenate([rank[word], none * 0])
        order = np.argsort(by_hash[history] * self.words + ranked)
        order = order[_stable(gram_bucket[order], level.buckets)]
        tag = np.concatenate([self.tags[word], none.view(np.uint64)])
        key, n = np.concatenate([key, none]), np.concatenate([n, none])
        return tuple(x[order] for x in (gram_bucket, hashes[history], history, tag, key, n))

    def answered(self, level: Level, bodies: list[pa.Scalar]) -> None:
        """Take the answers, by bucket, to what was asked: the next kept grams, and what follows the last ones."""
        bucket, hashed, history, _, key, _ = self.asked(level)
        counts, sums = [], []
        for body in bodies:
            numbers = _unpacked(body, "<i8")
            grams = int(numbers[0])
            counts.append(numbers[1 : grams + 1])
            sums.append(numbers[grams + 1 :].reshape(2, -1))
        gram = key >= 0
        count = np.concatenate([np.zeros(0, np.int64), *counts])
        key, count = key[gram][count > 0], count[count > 0]
        order = np.argsort(key)
        follow = np.zeros((2, len(self.keys[-1])), np.int64)
        group = np.append(True, (hashed[1:] != hashed[:-1]) | (bucket[1:] != bucket[:-1])) if len(hashed) else gram
        follow[:, history[group]] = np.concatenate([np.zeros((2, 0), np.int64), *sums], axis=1)
        place = _places(level.hot, self.hashes[-1])
        if len(level.hot):
            follow = np.where(place >= 0, level.sums[place].T, follow)
        self._add(key[order], count[order], follow)

    def automaton(self, model: Unigrams, discount: float) -> Automaton:
        """States are the empty history, 0, and all kept grams but the longest; a state's failure arc leads to the gram
        without its first word, with the weight of what the kept words leave over. An arc leads to the longest
        kept gram that ends there."""
        order = len(self.keys) - 1
        base = np.cumsum([1, *(len(k) for k in self.keys[1:order])])  # the first state of each length, from 1
        chance = model.chances(self.counts[1])
        of_words, shorter = np.log10(chance), np.arange(self.words)
        failure, weights = [np.zeros(1 + (self.words if order > 1 else 0), np.int64)], [np.zeros(1)]
        arcs, gains, following = [], [], []
        for size in range(2, order + 1):
            keys, count, every = self.keys[size], self.counts[size], np.maximum(self.counts[size - 1], 1)
            history, word = keys // self.words, keys % self.words
            kept, kinds = self.follow[size - 1]
            weight = np.where(kinds > 0, np.maximum(1 - (kept - discount * kinds) / every, 1e-12), 1.0)
            # the gram without its first word: kept as well, since it occurs at least as often
            suffix = word if size == 2 else _places(self.keys[size - 1], shorter[history] * self.words + word)
            chance = (count - discount) / every[history] + weight[history] * chance[suffix]
            shorter = suffix
            weights.append(np.log10(weight))
            arcs.append((base[size - 2] + history) * self.words + word)
            gains.append(np.log10(chance))
            last = size == order
            following.append(base[size - 2] + suffix if last else base[size - 1] + np.arange(len(keys)))
            if not last:
                failure.append(base[size - 2] + suffix)
        none = np.zeros(0, np.int64)
        return Automaton(
            self.words, of_words, np.concatenate([none, *arcs]), np.concatenate([none.astype(float), *gains]),
            np.concatenate([none, *following]), np.concatenate(failure), np.concatenate(weights), order,
        )


@dataclass(frozen=True)
class Automaton:
    """Arcs by state times ``words`` plus word, sorted; failure arcs and their log weights by state."""

    words: int
    of_words: np.ndarray
    arcs: np.ndarray
    gains: np.ndarray
    following: np.ndarray
    failure: np.ndarray
    weights: np.ndarray
    order: int

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and the log probabilities of the words: along failure arcs until one has an arc."""
        gain, following = np.zeros(len(state)), np.empty(len(state), np.int64)
        left = np.arange(len(state))
        while len(left):
            own, of = state[left], word[left]
            empty = own == 0
            done = left[empty]
            gain[done] += self.of_words[of[empty]]
            following[done] = 1 + of[empty] if self.order > 1 else 0
            left, own, of = left[~empty], own[~empty], of[~empty]
            at = _places(self.arcs, own * self.words + of)
            hit = at >= 0
            gain[left[hit]] += self.gains[at[hit]]
            following[left[hit]] = self.following[at[hit]]
            left, own = left[~hit], own[~hit]
            gain[left] += self.weights[own]
            state[left] = self.failure[own]
        return following, gain

    def walk(self, tokens: np.ndarray, sizes: np.ndarray, start: int) -> np.ndarray:
        """The log probability of each token, from left to right, all texts in step with their states carried.

        Long texts are cut into lanes that begin some words early, from the empty history: a state depends on no more
        words than the longest kept history has.
        """
        firsts = np.cumsum(sizes) - sizes
        lanes = -(-sizes // LANE)
        text = np.repeat(np.arange(len(sizes)), lanes)
        number = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = firsts[text] + number * LANE
        length = np.minimum(sizes[text] - number * LANE, LANE)
        early = np.where(number > 0, self.order - 1, 0)
        if self.order > LANE:
            raise ValueError("a lane must be longer than the longest history")
        state = np.where(number > 0, 0, 1 + start if self.order > 1 else 0)
        out = np.zeros(len(tokens))
        by = np.argsort(-(length + early), kind="stable")
        begin, early, state, total = (begin - early)[by], early[by], state[by], (length + early)[by]
        for t in range(int(total[0]) if len(total) else 0):
            now = int(np.searchsorted(-total, -t))  # lanes longer than t come first
            place = begin[:now] + t
            state[:now], gain = self.step(state[:now].copy(), tokens[place])
            own = t >= early[:now]
            out[place[own]] = gain[own]
        return out


def _requests(parts: DataFrame, level: Level) -> DataFrame:
    """(bucket, history, followers, tag, n, chunk): what each chunk asks, packed by bucket: each history once, the
    number of words asked behind it, and of each the tag and the count in own training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = Chunk({c: batch.column(c)[i] for c in batch.schema.names})
                bucket, hashed, _, tag, key, n = chunk.asked(level)
                if not len(bucket):
                    continue
                cuts, rows = _cuts(bucket), []
                for _, a, b in cuts:
                    gram = key[a:b] >= 0
                    first = np.flatnonzero(np.append(True, hashed[a + 1 : b] != hashed[a : b - 1]))
                    behind = np.add.reduceat(gram.astype(np.int64), first)
                    tags = np.ascontiguousarray(tag[a:b][gram]).view(np.uint8).reshape(-1, 8)[:, :5].T.tobytes()
                    deltas = _planes(np.diff(hashed[a:b][first], prepend=np.uint64(0)), "<u8")
                    rows.append((_packed(deltas), _packed(_planes(behind)), tags, _packed(_planes(n[a:b][gram]))))
                columns = {"bucket": [k for k, _, _ in cuts]} | dict(zip(("history", "followers", "tag", "n"), map(list, zip(*rows))))
                yield _rows(columns, chunk=chunk.row["chunk"].as_py())

    return parts.mapInArrow(run, "bucket long, history binary, followers binary, tag binary, n binary, chunk long")


def _counted(requests: DataFrame, level: Level, least: int, frequent: int) -> DataFrame:
    """The sums over all chunks. For each request a row, packed: the number of its grams, their counts, 0 if below
    ``least``, and of each history what follows it that is kept, count and kinds. These are in rows of
    their own for hot histories, which are in many buckets; n-grams of ``frequent`` occurrences are
    named as the hot histories of the next level."""
    hot = level.hot

    def count(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        packed = {c: [_unpacked(x, kind) for x in rows[c]] for c, kind in (("history", "<u8"), ("followers", "<i4"), ("n", "<i4"))}
        sizes, groups = ([len(x) for x in packed[c]] for c in ("n", "history"))
        asked = np.concatenate([np.cumsum(x, dtype=np.uint64) for x in packed["history"]])
        names, group = np.unique(asked, return_inverse=True)
        owner = np.repeat(group, np.concatenate(packed["followers"]))
        n = np.concatenate(packed["n"]).astype(np.int64)
        tag = np.zeros((len(n), 8), np.uint8)
        first = 0
        for x, size in zip(rows["tag"], sizes):
            tag[first : first + size, :5] = np.frombuffer(x.as_buffer(), np.uint8).reshape(5, -1).T
            first += size
        grams = _longer(names[owner], tag.view("<u8").ravel())
        order = np.argsort(grams)
        sorted_grams = grams[order]
        fresh = np.append(True, sorted_grams[1:] != sorted_grams[:-1])[: len(order)]
        begin = np.flatnonzero(fresh)
        total = np.add.reduceat(n[order], begin) if len(begin) else begin
        c = np.where(total >= least, total, 0)
        owners = owner[order[begin]]
        sums = np.stack([np.bincount(owners, weights=x, minlength=len(names)).astype(np.int64) for x in (c, c > 0)])
        is_hot = _places(hot, names) >= 0
        counts = np.empty(len(n), np.int64)
        counts[order] = c[np.cumsum(fresh) - 1]
        shown = np.where(is_hot, 0, sums)[:, group]
        large = np.flatnonzero(total >= frequent)
        further = sorted_grams[begin[large]]
        bodies = []
        for size, end, own, last in zip(sizes, np.cumsum(sizes), groups, np.cumsum(groups)):
            bodies.append(_packed(_planes(np.concatenate([[size], counts[end - size : end], shown[:, last - own : last].ravel()]), "<i8")))
        k, m, f = len(bodies), int(is_hot.sum()), len(large)
        return pa.table({
            "chunk": pa.concat_arrays([rows["chunk"].combine_chunks(), pa.nulls(m + f, pa.int64())]),
            "bucket": pa.array(np.full(k + m + f, rows["bucket"][0].as_py())),
            "body": pa.array(bodies + [None] * (m + f), pa.binary()),
            "hot": pa.array(np.concatenate([np.zeros(k, bool), np.ones(m, bool), np.zeros(f, bool)])),
            "name": pa.array(np.concatenate([np.zeros(k, np.int64), signed(names[is_hot]), signed(further)])),
            **{x: pa.array(np.concatenate([np.zeros(k, np.int64), sums[i][is_hot], np.zeros(f, np.int64)])) for i, x in enumerate(("kept", "kinds"))},
        })

    return requests.repartition(level.buckets, "bucket").groupBy("bucket").applyInArrow(
        count, "chunk long, bucket long, body binary, hot boolean, name long, kept long, kinds long"
    )


def _count_level(parts: DataFrame, size: int, buckets: int, names: np.ndarray, least: int, frequent: int) -> tuple[Level, DataFrame, str]:
    """The level with its hot histories, the answers to all chunks, and where they are written."""
    level = Level(size, buckets, names, np.zeros((len(names), 2), np.int64))
    found, path = _write(_counted(_requests(parts, level), level, least, frequent))
    sums = found.where("hot").groupBy("name").agg(*(F.sum(x) for x in ("kept", "kinds"))).toArrow()
    places = _places(names, sums["name"].to_numpy().astype(np.int64).view(np.uint64))
    level.sums[places] = np.stack([x.to_numpy() for x in sums.columns[1:]], axis=1)
    return level, found, path


def _told(left: pa.Table, right: pa.Table, buckets: int, level: Level | None) -> Chunk:
    """A chunk with the counts of its words and the answers of a level, as far as they came."""
    row = {c: left[c][0] for c in left.column_names}
    right = right.sort_by("bucket")
    words = right.filter(pc.equal(right["size"], 1))["body"]
    if len(words):
        order, _ = _by_bucket(np.frombuffer(row["vocabulary"].as_buffer(), np.uint64), buckets)
        c = np.zeros(len(order), np.int64)
        c[order] = np.concatenate([_unpacked(x, "<i8") for x in words])
        row["counts"] = pa.scalar(_packed(_planes(c, "<i8")), pa.binary())
    chunk = Chunk(row)
    if level is not None:
        chunk.answered(level, list(right.filter(pc.equal(right["size"], level.size))["body"]))
    return chunk


def _grower(shared: Broadcast):
    """The chunks as they were, with the answers of one level more."""

    def grow(left: pa.Table, right: pa.Table) -> pa.Table:
        level = shared.value
        known = _told(left, right, level.buckets, level)
        columns = {c: left[c] for c in left.column_names}
        columns["counts"] = pa.array([known.row["counts"].as_py()], pa.binary())
        columns["levels"] = pa.array([known.levels()], pa.list_(pa.binary()))
        return pa.table(columns)

    return grow


def score_texts(
    docs: DataFrame, train: Column, *, id: str = "doc_id", text: str = "text", order: int = 3, share: float = 0.0,
    discount: float = 0.75, chunk: int = CHUNK,
) -> DataFrame:
    """(id, train, n_tokens, n_known, train_tokens, base_score, score) of each document.

    Tokens are words between ASCII white space, A-Z lower-cased, and one end per text. Texts are dealt to chunks. Word
    counts of all training texts, however rare, are gathered by an aggregate and go back to each chunk of texts
    for its own dictionary; then, length by length, each chunk asks for the n-grams it has that may have been kept, for
    both their parts were: an n-gram is kept if it occurs twice (and makes up a ``share`` of the corpus, if one is
    asked for). ``base_score`` is the add-one unigram score in log10. ``score`` is that of the chunk's automaton:
    states are kept histories, arcs the words kept behind them, a failure arc leads to the longest kept suffix, and
    one pass from left to right carries the state of each text. p(w | h) is interpolated absolute discounting, and
    at the empty history a discounted unigram that leaves unseen words, as one, the discounts; so it is a
    distribution over the known words and one unknown word. Only frequent histories, at most 1 / HOT of each length,
    go through the driver. Null and empty texts are an end alone; a null
    ``train`` counts as false; rows that repeat count each; without training texts all scores are 0;
    an empty table gives no rows.
    """
    spark = docs.sparkSession
    with session_settings(spark, {CLEANUP: "true"}):
        return _score(docs, train, id, text, order, share, discount, chunk)


def _score(docs: DataFrame, train: Column, id: str, text: str, order: int, share: float, discount: float, chunk: int) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(F.col(id).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).alias("text"))
    parts, path = _write(chunks(rows, chunk))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts.count() // 4)
    words, words_path = _write(_count_words(parts, buckets))
    sums = [F.coalesce(F.sum(F.col("totals")[i]), F.lit(0)) for i in range(4)]
    tokens, distinct, once, twice = (int(x) for x in words.where("chunk IS NULL AND name IS NULL").agg(*sums).first())
    model = Unigrams(tokens, distinct, once / (once + 2 * twice) if once and twice else 0.5)
    least, frequent = max(2, math.ceil(share * tokens)), max(2, math.ceil(HOT * tokens))
    hot = words.where(F.col("name").isNotNull() & (F.col("totals")[0] >= frequent)).select("name")
    answers = words.where("chunk IS NOT NULL").select("chunk", F.lit(1).alias("size"), "bucket", "body")
    kind = docs.schema[id].dataType.simpleString()
    level = None
    for size in range(2, order + 1):
        names = np.sort(hot.toArrow()["name"].to_numpy().astype(np.int64).view(np.uint64))
        level, found, found_path = _count_level(parts, size, buckets, names, least, frequent if size < order else tokens + 1)
        own = found.where("chunk IS NOT NULL").select("chunk", F.lit(size).alias("size"), "bucket", "body")
        answers = answers.union(own) if size == 2 else own
        if size == order:
            break
        hot = stage(found.where("chunk IS NULL AND NOT hot").select("name"), "hot")
        shared = spark.sparkContext.broadcast(level)
        halves = []
        for half in range(2):
            own, told = (x.where(F.pmod(F.xxhash64("chunk"), F.lit(2)) == half).groupBy("chunk") for x in (parts, answers))
            halves.append(own.cogroup(told).applyInArrow(_grower(shared), _chunk_schema(kind)))
        grown, grown_path = _write(*halves)
        for old in (path, found_path, *([words_path] if size == 2 else [])):
            _delete(spark, old)
        parts, path = grown, grown_path
    shared = spark.sparkContext.broadcast((model, level))
    names = ["id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        model, level = shared.value
        known = _told(left, right, buckets, level)
        sizes, c = known.sizes, known.counts[1]
        token = known.sequence[~known.pad]
        firsts = np.cumsum(sizes) - sizes
        base = np.log10((c + 1) / (model.tokens + model.distinct + 1))
        gains = known.automaton(model, discount).walk(token, sizes, int(known.sequence[0]))
        return pa.table([
            known.row["ids"].values, pa.array(known.train), pa.array(sizes), pa.array(np.add.reduceat((c > 0)[token].astype(np.int64), firsts)),
            pa.array(np.full(len(sizes), model.tokens, np.int64)), pa.array(np.add.reduceat(base[token], firsts)), pa.array(np.add.reduceat(gains, firsts)),
        ], names)

    return parts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score, f"id {kind}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
