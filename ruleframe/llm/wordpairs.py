"""Surprise of texts under an interpolated modified Kneser-Ney model of word pairs, counted over all texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleframe.llm.automaton import CLEANUP, _by_bucket, _cuts, _longer, _packed, _places, _planes, _stable, _unpacked, _write
from ruleframe.llm.words import LOWER, SPACED, buffers, hashes, mix, pieces, spans, trimmed
from ruleframe.session import delete_path, fresh_path, session_settings

#: Tokens of a chunk: texts that share one dictionary and are scored together.
CHUNK = 1 << 21
#: Parts that pairs are counted in, and chunks scored in, one after the other: what one part shuffles goes before the next.
PARTS = 4
#: Places that the words behind one history are dealt out to, so that a frequent one is no task of its own.
SPREAD = 4


def _tag(hashed: np.ndarray) -> np.ndarray:
    """Words are told apart by 40 bits of their hash."""
    return mix(hashed) >> np.uint64(24)


#: The tag of the token that ends every text, and stands before its first one.
END = _tag(np.array([0x656E64], np.uint64))


def _tags(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :5].T.tobytes()


def _untagged(body: pa.Scalar) -> np.ndarray:
    planes = np.frombuffer(body.as_buffer(), np.uint8).reshape(5, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :5] = planes.T
    return out.view("<u8").ravel()


def discounts(n: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more (of 0: nothing), from how many counts are 1 to 4."""
    if not n[0] or not n[1]:
        return np.array([0, 0.5, 0.5, 0.5])
    y = n[0] / (n[0] + 2 * n[1])
    found = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k / 2 for k in (1, 2, 3)]
    return np.array([0, *(min(max(d, 0.0), float(k)) for k, d in enumerate(found, 1))])


def chance_by_others(count: np.ndarray, total: np.ndarray, kinds: list, less: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """The interpolated chance of what was counted ``count`` times of ``total``, one of these being itself and taken off;
    ``kinds``: how many things were counted once, twice and more often."""
    once, twice, thrice = count == 1, count == 2, count == 3
    kinds = [kinds[0] - once + twice, kinds[1] - twice + thrice, kinds[2] - thrice]
    count, total = count - 1, total - 1
    every = np.maximum(total, 1)
    found = count - less[np.minimum(count, 3)] + sum(d * k for d, k in zip(less[1:], kinds)) * shorter
    return np.where(total > 0, found / every, shorter)


def chance_by_all(count: np.ndarray, total: float, kinds: list, less: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    return (count - less[np.minimum(count, 3)] + sum(d * k for d, k in zip(less[1:], kinds)) * shorter) / max(total, 1)


def _chunks(rows: DataFrame, text: str, spell: Callable, size: int, added: list[T.StructField], add: Callable | None) -> DataFrame:
    """One row for about ``size`` tokens: the other columns of the texts, their numbers of tokens, the tokens as numbers,
    and of each word its tag and the log chance of its spelling."""
    at = rows.columns.index(text)
    fields = T.StructType([*rows.drop(text).schema.fields, *added])
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("rows", T.ArrayType(fields))])
    for name in ("sizes", "tokens", "vocabulary", "spelling"):
        schema.add(name, T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, speller = TaskContext.get().partitionId(), 0, spell()
        held, known, count = [], [END], 0  # known: words of the chunk that are new in a piece
        no_word = speller(np.zeros(0, np.uint8), *np.zeros((2, 1), np.int64))  # the end is spelled like it
        spelled = [no_word]

        def flush():
            nonlocal held, known, spelled, count, number
            columns = [pa.concat_arrays([h[0][i] for h in held]) for i in range(len(fields))]
            sizes = np.concatenate([h[1] for h in held])
            words, of_words = np.concatenate(known), np.concatenate(spelled)
            vocabulary, first = np.unique(words, return_index=True)
            end = np.searchsorted(vocabulary, END[0])
            token = np.concatenate([np.insert(np.searchsorted(vocabulary, own)[place], bounds, end) for _, _, own, place, bounds in held])
            order = np.argsort(-np.bincount(token, minlength=len(vocabulary)), kind="stable")  # small numbers compress
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            struct = pa.StructArray.from_arrays(columns, fields.names)
            binary = (sizes.astype("<i8").tobytes(), _packed(_planes(place[token])), _tags(vocabulary[order]), of_words[first][order].astype("<f4").tobytes())
            arrays = [pa.array([task << 32 | number]), pa.ListArray.from_arrays([0, len(struct)], struct), *(pa.array([b], pa.binary()) for b in binary)]
            held, known, spelled, count = [], [END], [no_word], 0
            number += 1
            return pa.RecordBatch.from_arrays(arrays, schema.names)

        for whole in add(batches) if add else batches:
            for batch in pieces(whole, whole.schema.names[at]):
                data, offsets = buffers(batch.column(at))
                data = LOWER[data]
                starts, ends = spans(data, offsets, SPACED)
                bounds = np.searchsorted(starts, offsets)
                tags = _tag(hashes(data, starts, ends))
                own, first, at_own = np.unique(tags, return_index=True, return_inverse=True)
                new = own
                for seen in known:
                    fresh = _places(seen, new) < 0
                    new, first = new[fresh], first[fresh]
                known.append(new)
                spelled.append(speller(data, starts[first], ends[first]))
                columns = [batch.column(i) for i in range(batch.num_columns) if i != at]
                held.append((columns, np.diff(bounds) + 1, own, at_own.astype(np.int32), bounds[1:]))
                count += len(tags) + batch.num_rows
                if count >= size:
                    yield flush()
        if held:
            yield flush()

    return rows.mapInArrow(trimmed(run), schema)


def _counted(values: np.ndarray) -> tuple[np.ndarray, None, np.ndarray]:
    found, n = np.unique(values, return_counts=True)
    return found, None, n


class _Chunk:
    """The words of a chunk in the order of their tags, and its distinct pairs in the order of both."""

    def __init__(self, sizes: pa.Scalar, tokens: pa.Scalar, vocabulary: pa.Scalar, places: bool = False):
        self.sizes = np.frombuffer(sizes.as_buffer(), "<i8")
        tags = _untagged(vocabulary)
        self.by_tag = np.argsort(tags)
        self.tags = tags[self.by_tag]
        rank = np.empty(len(tags), np.int64)
        rank[self.by_tag] = np.arange(len(tags))
        token = rank[_unpacked(tokens, "<i4")]
        before = np.append(0, token[:-1])
        before[np.cumsum(self.sizes) - self.sizes] = np.searchsorted(self.tags, END[0])
        before *= len(tags)
        before += token
        # Where the pairs are in the texts costs most of it.
        pairs, self.at, self.n = np.unique(before, return_inverse=True, return_counts=True) if places else _counted(before)
        self.history, self.word = np.divmod(pairs, len(tags))

    def dealt(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """The order of the pairs by bucket and tags, and their buckets in that order."""
        hashed = mix(self.tags)
        part = hashed % np.uint64(SPREAD) * np.uint64(0x9E3779B97F4A7C15)
        bucket = ((mix(hashed)[self.history] ^ part[self.word]) % np.uint64(buckets)).astype(np.int64)
        order = _stable(bucket, buckets)
        return order, bucket[order]


def _requests(parts: DataFrame, buckets: int, part: int) -> DataFrame:
    """(bucket, chunk, history, followers, word, n): the pairs of each chunk in the buckets of a part, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = _Chunk(*(batch[c][i] for c in ("sizes", "tokens", "vocabulary")))
                order, bucket = chunk.dealt(buckets)
                own = bucket % PARTS == part
                order, bucket = order[own], bucket[own]
                history, word, n = chunk.history[order], chunk.tags[chunk.word[order]], chunk.n[order]
                cuts, bodies = _cuts(bucket), []
                if not len(bucket):
                    continue
                for _, a, b in cuts:
                    first = np.flatnonzero(np.append(True, history[a + 1 : b] != history[a : b - 1]))
                    deltas = np.diff(chunk.tags[history[a:b][first]], prepend=np.uint64(0))
                    followers = np.diff(first, append=b - a)
                    bodies.append((_packed(_planes(deltas, "<u8")), _packed(_planes(followers)), _tags(word[a:b]), _packed(_planes(n[a:b]))))
                columns = [pa.array([k for k, _, _ in cuts], pa.int64()), pa.array([batch["chunk"][i].as_py()] * len(cuts), pa.int64())]
                columns += [pa.array(x, pa.binary()) for x in zip(*bodies)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "chunk", "history", "followers", "word", "n"])

    return parts.select("chunk", "sizes", "tokens", "vocabulary").mapInArrow(trimmed(run), "bucket long, chunk long, history binary, followers binary, word binary, n binary")


_COUNTED = "chunk long, bucket long, tags binary, body binary, totals array<long>"


def _table(chunk: list, bucket: list, tags: list, body: list, totals: list) -> pa.Table:
    """The rows of a bucket, and one of its totals."""
    end = [None]
    columns = [pa.array(x + end, t) for x, t in ((chunk, pa.int64()), (bucket, pa.int64()), (tags, pa.binary()), (body, pa.binary()))]
    columns.append(pa.array([None] * len(chunk) + [totals], pa.list_(pa.int64())))
    return pa.table(columns, ["chunk", "bucket", "tags", "body", "totals"])


def _count_pairs(requests: DataFrame, buckets: int) -> DataFrame:
    """For each request the counts of its pairs in all chunks; of each word, by its own bucket, how often it stands before
    others, how many of these pairs occur once, twice and more often, and how many words stand before it; and how
    many pairs occur once to four times."""

    def count(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        n = [_unpacked(x, "<i4") for x in rows["n"]]
        sizes = [len(x) for x in n]
        history = np.concatenate([
            np.repeat(np.cumsum(_unpacked(h, "<u8"), dtype=np.uint64), _unpacked(f, "<i4")) for h, f in zip(rows["history"], rows["followers"])
        ])
        word = np.concatenate([_untagged(x) for x in rows["word"]])
        _, first, which = np.unique(_longer(history, word), return_index=True, return_inverse=True)
        c = np.bincount(which, weights=np.concatenate(n)).astype(np.int64)
        history, word, counts = history[first], word[first], c[which]
        bodies = [_packed(_planes(counts[e - s : e], "<i8")) for s, e in zip(sizes, np.cumsum(sizes))]
        tags, place = np.unique(np.concatenate([history, word]), return_inverse=True)
        before, behind = place[: len(c)], place[len(c) :]
        sums = [np.bincount(before, weights=x, minlength=len(tags)) for x in (c, c == 1, c == 2, c > 2)]
        stats = np.stack([*sums, np.bincount(behind, minlength=len(tags))]).astype(np.int64)
        order, of = _by_bucket(tags, buckets)
        cuts = _cuts(of)
        tags, stats = tags[order], stats[:, order]
        named = [_packed(_planes(np.diff(tags[a:b], prepend=np.uint64(0)), "<u8")) for _, a, b in cuts]
        told = [_packed(_planes(stats[:, a:b].ravel(), "<i8")) for _, a, b in cuts]
        chunk, bucket = rows["chunk"].to_pylist() + [None] * len(cuts), rows["bucket"].to_pylist() + [k for k, _, _ in cuts]
        return _table(chunk, bucket, [None] * len(sizes) + named, bodies + told, [int((c == k).sum()) for k in (1, 2, 3, 4)])

    return requests.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(count, _COUNTED)


def _count_words(parts: DataFrame, counted: DataFrame, buckets: int, part: int) -> DataFrame:
    """For each chunk and bucket of a part what :func:`_count_pairs` found of its words, added up; and how many words stand behind
    one to four others, behind three or more, and all of these pairs."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tags = _untagged(batch["vocabulary"][i])
                order, bucket = _by_bucket(tags, buckets)
                tags, cuts = tags[order], [c for c in _cuts(bucket) if c[0] % PARTS == part]
                if not cuts:
                    continue
                bodies = [_packed(_planes(np.diff(tags[a:b], prepend=np.uint64(0)), "<u8")) for _, a, b in cuts]
                columns = [pa.array([batch["chunk"][i].as_py()] * len(cuts), pa.int64()), pa.array([k for k, _, _ in cuts], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(bodies, pa.binary())], ["chunk", "bucket", "tags"])

    def add(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        of, told = rows.filter(pc.is_valid(rows["chunk"])), rows.filter(pc.is_null(rows["chunk"]))
        tags, which = np.unique(np.concatenate([np.cumsum(_unpacked(x, "<u8"), dtype=np.uint64) for x in told["tags"]]), return_inverse=True)
        parts = np.concatenate([_unpacked(x, "<i8").reshape(5, -1) for x in told["body"]], axis=1)
        stats = np.stack([np.bincount(which, weights=x) for x in parts]).astype(np.int64)
        asked = [np.searchsorted(tags, np.cumsum(_unpacked(x, "<u8"), dtype=np.uint64)) for x in of["tags"]]
        left = stats[4]
        totals = [*(int((left == k).sum()) for k in (1, 2, 3, 4)), int((left > 2).sum()), int(left.sum())]
        bodies = [_packed(_planes(stats[:, x].ravel(), "<i8")) for x in asked]
        return _table(of["chunk"].to_pylist(), of["bucket"].to_pylist(), [None] * len(asked), bodies, totals)

    asked = parts.select("chunk", "vocabulary").mapInArrow(ask, "chunk long, bucket long, tags binary").withColumn("body", F.lit(None).cast("binary"))
    told = counted.where("kind = 'words'").where(F.col("bucket") % PARTS == part)
    rows = asked.union(told.select("chunk", "bucket", "tags", "body"))
    return rows.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(add, _COUNTED)


def _written_by_kind(*parts: DataFrame) -> tuple[DataFrame, str]:
    """Answers, counts of words, and totals in folders of their own, so that one can go before the others. Also the path."""
    spark = parts[0].sparkSession
    path = fresh_path(spark, "pairs")
    kind = F.when(F.col("chunk").isNotNull(), "answers").when(F.col("tags").isNotNull(), "words").otherwise("totals")
    options = {"parquet.block.size": 16 << 20, "parquet.enable.dictionary": "false", "compression": "zstd"}
    for rows in parts:
        rows.withColumn("kind", kind).write.options(**options).partitionBy("kind").mode("append").parquet(path)
    return spark.read.schema(f"{_COUNTED}, kind string").parquet(path), path


def _totals(counted: DataFrame, size: int) -> list[int]:
    sums = [F.coalesce(F.sum(F.col("totals")[i]), F.lit(0)) for i in range(size)]
    return [int(x) for x in counted.where("totals IS NOT NULL").agg(*sums).first()]


def with_word_surprise(
    rows: DataFrame, spell: Callable, *, text: str = "text", name: str = "surprise", chunk: int = CHUNK,
    added: tuple[T.StructField, ...] = (), add: Callable | None = None,
) -> DataFrame:
    """The other columns of the rows with ``name``: the mean surprise in nats of the text's words and its end. Before
    them may stand columns ``added`` to Arrow batches by ``add``, in the tasks that read the texts.

    Words stand between ASCII white space, A-Z lower-cased. A word's chance behind the one before it is interpolated,
    with modified Kneser-Ney discounts: pairs are counted over all texts, however rare they are; single words count
    the different words that stand before them, and share what is taken off with their spelling, of which
    ``spell()`` in a task makes a function of bytes, starts and ends of words that returns log chances. As the texts
    themselves were counted, each token is judged by all others: its own occurrence is taken off every count.

    Texts are dealt to chunks of ``chunk`` tokens that ask for the counts of their distinct pairs, packed, by buckets of pairs; what stands
    before and behind a word is then added up by buckets of words. Nothing but a few totals goes through the driver.
    Null and empty texts are an end alone.
    """
    spark = rows.sparkSession
    with session_settings(spark, {CLEANUP: "true"}):
        parts, parts_path = _write(_chunks(rows, text, spell, chunk, list(added), add))
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts.count() // 2)
        pairs, pairs_path = _written_by_kind(*(_count_pairs(_requests(parts, buckets, part), buckets) for part in range(PARTS)))
        words, words_path = _write(*(_count_words(parts, pairs, buckets, part) for part in range(PARTS)))
        delete_path(spark, f"{pairs_path}/kind=words")
        less = discounts(_totals(pairs.where("kind = 'totals'"), 4))
        kinds = _totals(words, 6)
        less_words, of_words, distinct = discounts(kinds[:4]), [kinds[0], kinds[1], kinds[4]], kinds[5]
        found = ((2, pairs.where("kind = 'answers'")), (1, words.where("chunk IS NOT NULL")))
        answers = [x.select("chunk", F.lit(size).alias("size"), "bucket", "body") for size, x in found]
        schema = T.StructType([*rows.drop(text).schema.fields, *added, T.StructField(name, T.DoubleType())])

        def score(left: pa.Table, right: pa.Table) -> pa.Table:
            own = _Chunk(*(left[c][0] for c in ("sizes", "tokens", "vocabulary")), places=True)
            right = right.sort_by("bucket")
            bodies = {size: right.filter(pc.equal(right["size"], size))["body"] for size in (1, 2)}
            order, _ = own.dealt(buckets)
            count = np.empty(len(order), np.int64)
            count[order] = np.concatenate([_unpacked(x, "<i8") for x in bodies[2]])
            order, _ = _by_bucket(own.tags, buckets)
            stats = np.empty((5, len(order)), np.int64)
            stats[:, order] = np.concatenate([_unpacked(x, "<i8").reshape(5, -1) for x in bodies[1]], axis=1)
            spelled = np.exp(np.frombuffer(left["spelling"][0].as_buffer(), "<f4").astype(float))[own.by_tag]
            total, before = stats[0], stats[4]
            # A pair that occurs again still counts for its second word.
            again = chance_by_all(before, distinct, of_words, less_words, spelled)
            alone = chance_by_others(before, np.full(len(before), distinct), of_words, less_words, spelled)
            shorter = np.where(count > 1, again[own.word], alone[own.word])
            chance = chance_by_others(count, total[own.history], [x[own.history] for x in stats[1:4]], less, shorter)
            surprise = -np.log(np.maximum(chance, 1e-300))[own.at]
            mean = np.add.reduceat(surprise, np.cumsum(own.sizes) - own.sizes) / own.sizes
            return pa.table([*left["rows"].combine_chunks().values.flatten(), pa.array(mean)], schema.names)

        scored = []
        for part in range(PARTS):
            own, told = (x.where(F.pmod(F.xxhash64("chunk"), F.lit(PARTS)) == part).groupBy("chunk") for x in (parts, answers[0].union(answers[1])))
            scored.append(own.cogroup(told).applyInArrow(score, schema))
        found, _ = _write(*scored)
        for path in (parts_path, pairs_path, words_path):
            delete_path(spark, path)
        return found
