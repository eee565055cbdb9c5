"""SimHash fingerprints and their near-duplicate groups, compared bit plane by bit plane."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleframe.llm.components import connected_components
from ruleframe.llm.words import buffers, trimmed
from ruleframe.session import stage

#: Bits of a byte value, most significant first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
#: A bucket with more fingerprints is dealt out again by more bits.
BUCKET = 512
#: Comparisons of a fingerprint with a block that are held in memory at a time.
ITEMS = 1 << 18


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text: words between ASCII white space, A-Z lower-cased, all shingles
    (the whole sequence if there are fewer words), XXH64 with seed 42. No words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        values = np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
        ends = ends[shingle - 1 :].tolist()
        digest = xxhash.xxh64_intdigest
        values = np.fromiter(
            (digest(joined[a:b], 42) for a, b in zip(starts, ends)), np.uint64, len(starts)
        )
    lanes = values.astype(">u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(lanes[:, i], minlength=256) @ _BITS for i in range(8)])
    return int.from_bytes(np.packbits(2 * ones > len(values)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with one more long column, the fingerprint's 64 bits. A null text has no words."""
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([f for f in docs.schema if f.name != name] + [StructField(name, LongType())])
    docs = docs.drop(name)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(place))
            prints = np.fromiter(
                (fingerprint(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])),
                np.uint64, len(offsets) - 1,
            )
            arrays = [*batch.columns, pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, name])

    return docs.mapInArrow(trimmed(run), schema)


def _parts(bits: list[int], count: int) -> list[list[int]]:
    return [list(map(int, x)) for x in np.array_split(bits, count)]


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def bucket_keys(radius: int) -> list[tuple[int, list[int]]]:
    """(bits that must agree as a mask, the others): ``radius`` differing bits leave at least two of
    radius + 2 parts untouched, so every pair within the radius meets under one of these masks."""
    parts = _parts(list(range(64)), radius + 2)
    keys = []
    for kept in combinations(range(len(parts)), 2):
        same = [b for i in kept for b in parts[i]]
        keys.append((_mask(same), [b for b in range(64) if b not in same]))
    return keys


def refined_keys(rest: list[int], radius: int) -> list[tuple[int, list[int]]]:
    """The same for the bits a bucket leaves open: one of radius + 1 parts is untouched."""
    parts = _parts(rest, radius + 1)
    return [(_mask(p), [b for b in rest if b not in p]) for p in parts if p]


def within(prints: np.ndarray, row: np.ndarray, block: np.ndarray, planes: np.ndarray, sizes: np.ndarray, radius: int):
    """Which members of a block of at most 64 differ from a fingerprint in at most ``radius`` bits.

    ``planes[b, k]`` holds bit b of all members of block k, one per bit. Item i compares fingerprint
    ``prints[row[i]]`` with block ``block[i]``: per bit plane one XOR gives the members that differ,
    which a carry-save counter of three bits and an overflow adds up for 64 members at a time. Every
    few planes the items whose members are all beyond the radius are abandoned. Returns the items
    left and their members as bits.
    """
    item = np.arange(len(row))
    valid = np.where(sizes >= 64, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (sizes % 64).astype(np.uint64)) - np.uint64(1))[block]
    over = ~valid
    one, two, four = (np.zeros(len(row), np.uint64) for _ in range(3))
    for b in range(64):
        own = -((prints[row] >> np.uint64(b)) & np.uint64(1)).astype(np.int64)
        carry = planes[b, block] ^ own.view(np.uint64)
        one, carry = one ^ carry, one & carry
        two, carry = two ^ carry, two & carry
        four, carry = four ^ carry, four & carry
        over |= carry
        if radius < 7:
            value = (one, two, four)
            beyond = np.zeros(len(row), np.uint64)  # members whose counter is above the radius
            equal = np.full(len(row), NONE)
            for place in (2, 1, 0):
                if radius >> place & 1:
                    equal &= value[place]
                else:
                    beyond |= equal & value[place]
                    equal &= ~value[place]
            over |= beyond
        if b % 8 == 7:
            live = over != NONE
            if not live.all():
                row, block, item, over, one, two, four = (x[live] for x in (row, block, item, over, one, two, four))
                if not len(row):
                    break
    return item, ~over


NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def bucket_links(prints: np.ndarray, bucket: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is connected inside each bucket: every fingerprint and the smallest of
    its component. ``bucket`` numbers the buckets, ascending; their rows stand together."""
    count = len(prints)
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    size = np.diff(np.append(first, count))
    blocks = (size + 63) // 64
    block_bucket = np.repeat(np.arange(len(first)), blocks)
    within_bucket = np.arange(len(block_bucket)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    block_first = first[block_bucket] + 64 * within_bucket
    block_size = np.minimum(64, first[block_bucket] + size[block_bucket] - block_first)
    lane = np.arange(count) - np.repeat(block_first, block_size)
    block_of = np.repeat(np.arange(len(block_first)), block_size)
    planes = np.zeros((64, len(block_first)), np.uint64)
    starts = np.flatnonzero(lane == 0)
    for b in range(64):
        bits = ((prints >> np.uint64(b)) & np.uint64(1)) << lane.astype(np.uint64)
        planes[b] = np.bitwise_or.reduceat(bits, starts)
    # Every row meets every block of its bucket, some rows at a time.
    times = np.repeat(blocks, size)
    start_block = np.repeat(np.cumsum(blocks) - blocks, size)
    met = np.cumsum(times)
    found, at = [], 0
    while at < count:
        to = max(at + 1, int(np.searchsorted(met, (met[at - 1] if at else 0) + ITEMS, "right")))
        some = times[at:to]
        row = np.repeat(np.arange(at, to), some)
        block = np.arange(len(row)) - np.repeat(np.cumsum(some) - some, some) + np.repeat(start_block[at:to], some)
        item, members = within(prints, row, block, planes, block_size, radius)
        hit = np.unpackbits(members.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, bit = np.nonzero(hit)
        found.append((row[item[which]], block_first[block[item[which]]] + bit))
        at = to
    a, b = (np.concatenate(x) for x in zip(*found))
    # Rows of a bucket are sorted, so the smallest row number is the smallest fingerprint.
    label = np.arange(count)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    linked = label != np.arange(count)
    return prints[linked], prints[label[linked]]


def fingerprint_links(prints: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links within ``radius`` between distinct fingerprints (long column ``fp``), as many as
    connect what is connected.

    Candidates agree in two of radius + 2 parts of their bits. A bucket with more than ``bucket``
    fingerprints is dealt out again by parts of the bits that it leaves open, and so on: each round
    fixes more bits, so however dense a bucket is, it falls apart into ones that a task can hold, and
    no pair within the radius is lost. Ends, since distinct fingerprints differ in some open bit.
    """
    spark = prints.sparkSession
    levels = [(0, list(range(64)))]
    todo = prints.select("fp", F.lit(0).alias("level"), F.lit(0).cast("long").alias("key"))
    found = []
    depth = 0
    while True:
        keys = []  # (level before, mask, open bits)
        for number, (mask, rest) in enumerate(levels):
            if depth == 0:
                keys += [(number, m, r) for m, r in bucket_keys(radius)]
            elif len(rest) > 8:
                keys += [(number, mask | m, r) for m, r in refined_keys(rest, radius)]
        table = spark.createDataFrame(
            [(n, i, m) for i, (n, m, _) in enumerate(keys)], "level int, next int, mask long"
        )
        rows = todo.join(F.broadcast(table), "level").select(  # at most 10 * 4 ** depth rows
            F.col("next").alias("level"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"
        )
        rows = stage(rows, "buckets")
        crowded = stage(rows.groupBy("level", "key").count().where(F.col("count") > bucket).select("level", "key"), "crowded")
        last = depth == 3 or crowded.isEmpty()
        small = rows if last else rows.join(crowded, ["level", "key"], "left_anti")
        found.append(_search(small, radius))
        if last:
            break
        todo = rows.join(crowded, ["level", "key"], "left_semi")
        levels = [(m, r) for _, m, r in keys]
        depth += 1
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return links.distinct()


def _search(rows: DataFrame, radius: int) -> DataFrame:
    """Links inside the buckets (level, key) of ``rows``; each bucket passes through one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((3, 0), np.int64)

        def compare(part: np.ndarray) -> Iterator[pa.RecordBatch]:
            new = np.concatenate(([True], (part[:2, 1:] != part[:2, :-1]).any(axis=0)))
            number = np.cumsum(new) - 1
            size = np.bincount(number)
            many = size[number] > 1
            part, number, size = part[:, many], number[many], size[size > 1]
            at, cells = 0, np.cumsum(size.astype(np.int64) ** 2)
            rows_before = np.concatenate(([0], np.cumsum(size)))
            while at < len(size):
                base = cells[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(cells, base + (1 << 21), "right")))
                rows = slice(rows_before[at], rows_before[to])
                a, b = bucket_links(part[2, rows].view(np.uint64), number[rows], radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])
                at = to

        for batch in batches:
            part = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)])
            part = np.concatenate([rest, part], axis=1)
            if not part.shape[1]:
                continue
            ends = np.flatnonzero((part[:2, 1:] != part[:2, :-1]).any(axis=0))
            cut = int(ends[-1]) + 1 if len(ends) else 0
            if cut:
                yield from compare(np.ascontiguousarray(part[:, :cut]))
            rest = part[:, cut:]
        if rest.shape[1]:
            yield from compare(np.ascontiguousarray(rest))

    dealt = rows.select("level", "key", "fp").repartition("level", "key")
    # Unsigned order within a bucket does not matter; equal keys must stand together.
    return dealt.sortWithinPartitions("level", "key", "fp").mapInArrow(trimmed(run), "a long, b long")


def near_duplicates(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", radius: int = 3, bucket: int = BUCKET
) -> DataFrame:
    """(row, id, fingerprint, component) for each document; ``row`` numbers the rows.

    Documents are linked if their fingerprints differ in at most ``radius`` bits; ``component`` is
    the smallest id that can be reached over links, the own one included. A null or empty text has
    fingerprint 0 and is linked like any other; a null id belongs to a component but never names it
    (null if there is no other); rows that repeat are rows of their own with the same result. An empty
    table gives no rows. Only fingerprints are shuffled, each distinct one once.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), F.col(text).alias("text"))
    return _components(with_fingerprints(rows, "text", "fp").select("row", "id", "fp"), radius, bucket)


def _components(rows: DataFrame, radius: int, bucket: int) -> DataFrame:
    marked = stage(rows, "fingerprints")
    prints = stage(marked.groupBy("fp").agg(F.min("id").alias("id")), "prints")
    roots = connected_components(fingerprint_links(prints, radius, bucket))
    of = prints.join(roots, prints.fp == roots.node, "left").select(
        "fp", "id", F.coalesce("component", "fp").alias("root")
    )
    names = of.groupBy("root").agg(F.min("id").alias("component"))
    named = of.join(names, "root").select("fp", "component")
    return marked.join(named, "fp").select("row", "id", F.col("fp").alias("fingerprint"), "component")


def drop_near_duplicates(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", radius: int = 3, bucket: int = BUCKET
) -> DataFrame:
    """``docs`` with one document of each component: the smallest id, null last, then the first row.

    The documents are written once with a row number and their fingerprint, since the rows to drop
    are known only after all fingerprints have been compared.
    """
    numbered = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"), F.monotonically_increasing_id().alias("row"))
    numbered = numbered.select("*", F.col(f"doc.{text}").alias("text"))
    marked = stage(with_fingerprints(numbered, "text", "fp").drop("text"), "documents")
    found = stage(_components(marked.select("row", F.col(f"doc.{id}").alias("id"), "fp"), radius, bucket), "components")
    best = F.min(F.struct(F.col("id").isNull(), "id", "row"))
    kept = found.groupBy("component", F.when(F.col("component").isNull(), F.col("fingerprint"))).agg(best.alias("best"))
    # Row numbers to drop, written before they meet the documents: the planner knows their size, and
    # sends them to the documents instead of moving these, as long as they are few.
    dropped = stage(found.select("row").join(kept.select(F.col("best.row").alias("row")), "row", "left_anti"), "dropped")
    return marked.join(dropped, "row", "left_anti").select("doc.*")
