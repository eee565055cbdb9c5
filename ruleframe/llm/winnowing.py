"""Benchmark decontamination: winnowed fingerprints of documents and benchmark items, joined and extended."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ruleframe.llm.words import ALNUM, buffers, grams, hashes, LOWER, pieces, signed, spans, trimmed
from ruleframe.session import stage

#: Bits of the filter that is sent to all tasks: 2 MB, whatever the size of the benchmark.
FILTER_BITS = 1 << 24
_BITMAP = 32768  # fixed value: bits of one bitmap of Spark's bitmap functions


def _select(words: np.ndarray, text_of: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Winnowing: places and hashes of the grams kept, the last smallest hash of each ``span`` words.

    ``span`` words hold span - gram + 1 grams, so every run of ``span`` words keeps at least one, and
    equal runs keep the same one.
    """
    count = len(words) - span + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashed = grams(words, gram)
    least = hashed[:count].copy()
    at = np.arange(count)
    for i in range(1, span - gram + 1):
        here = hashed[i : i + count]
        better = here <= least
        least = np.where(better, here, least)
        at = np.where(better, np.arange(i, i + count), at)
    inside = text_of[:count] == text_of[span - 1 :]
    kept = np.unique(at[inside])
    return kept, hashed[kept]


def _words(batch: pa.RecordBatch, place: int):
    data, offsets = buffers(batch.column(place))
    data = LOWER[data]
    starts, ends = spans(data, offsets, ALNUM)
    text_of = np.searchsorted(offsets, starts, "right") - 1
    return data, offsets, starts, ends, text_of


def _lists(rows: int, row_of: np.ndarray, columns: dict[str, pa.Array]) -> pa.ListArray:
    ends = np.searchsorted(row_of, np.arange(rows), "right").astype(np.int32)
    values = pa.StructArray.from_arrays(list(columns.values()), names=list(columns))
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), values)


def item_windows(items: DataFrame, span: int, gram: int) -> DataFrame:
    """(item, span, window, print): every window of every item with the fingerprint winnowing keeps of
    it. An item of fewer words than ``span`` is one window of its own length; null ids stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text", 1 << 18):
                data, offsets, starts, ends, _ = _words(batch, 1)
                hashed = hashes(data, starts, ends)
                bounds = np.searchsorted(starts, offsets)
                ids = batch.column(0).to_pylist()
                rows = []
                for item, first, last in zip(ids, bounds[:-1], bounds[1:]):
                    size = min(span, int(last - first))
                    if not size:
                        continue
                    text = [data[a:b].tobytes().decode() for a, b in zip(starts[first:last], ends[first:last])]
                    for i in range(len(text) - size + 1):
                        own = hashed[first + i : first + i + size]
                        _, prints = _select(own, np.zeros(size, np.int64), size, min(gram, size))
                        rows.append((item, size, " ".join(text[i : i + size]), int(signed(prints)[0])))
                if rows:
                    item, size, window, prints = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(item, batch.schema.types[0]), pa.array(size, pa.int32()), pa.array(window), pa.array(prints)],
                        ["item", "span", "window", "print"],
                    )

    kind = items.schema["item"].dataType.simpleString()
    return items.select("item", "text").mapInArrow(trimmed(run), f"item {kind}, span int, window string, print long")


def _filter(prints: DataFrame, bits: int) -> bytes:
    """A bit for each fingerprint, by its lowest bits; its size does not depend on the table's."""
    place = F.col("print").bitwiseAND(bits - 1)
    parts = (
        prints.select(place.alias("place"))
        .groupBy(F.floor(F.col("place") / _BITMAP).alias("part"))
        .agg(F.bitmap_construct_agg(F.col("place") % _BITMAP).alias("bits"))
    )
    out = bytearray(bits // 8)
    for row in parts.collect():  # at most bits / 32768 rows
        out[row.part * _BITMAP // 8 : (row.part + 1) * _BITMAP // 8] = row.bits
    return bytes(out)


def seeds(docs: DataFrame, lengths: list[int], span: int, gram: int, bits) -> DataFrame:
    """(row, id, n_words, seeds) for (row, id, text): the kept fingerprints of each text that pass the
    filter, with the words around that a window may reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = np.frombuffer(bits.value, np.uint8)
        for whole in batches:
            for batch in pieces(whole, "text"):
                data, offsets, starts, ends, text_of = _words(batch, 2)
                hashed = hashes(data, starts, ends)
                bounds = np.searchsorted(starts, offsets)
                found = []
                for size in lengths:
                    places, prints = _select(hashed, text_of, size, min(gram, size))
                    low = prints & np.uint64(FILTER_BITS - 1)
                    passed = (allowed[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    for place, value in zip(places[passed].tolist(), signed(prints[passed]).tolist()):
                        text = text_of[place]
                        first = max(bounds[text], place - size + min(gram, size))
                        last = min(bounds[text + 1], place + size)
                        around = b" ".join(data[starts[i] : ends[i]].tobytes() for i in range(first, last))
                        found.append((text, size, value, first - bounds[text], around.decode()))
                found.sort()
                row_of, size, value, first, around = zip(*found) if found else ((),) * 5
                lists = _lists(batch.num_rows, np.array(row_of, np.int64), {
                    "span": pa.array(size, pa.int32()), "print": pa.array(value, pa.int64()),
                    "first": pa.array(first, pa.int32()), "around": pa.array(around, pa.string()),
                })
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(np.diff(bounds)), lists], ["row", "id", "n_words", "seeds"]
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("row", "id", "text").mapInArrow(
        trimmed(run), f"row long, id {kind}, n_words long, seeds array<struct<span: int, print: long, first: int, around: string>>"
    )


def contamination(
    docs: DataFrame, items: DataFrame, *, id: str = "doc_id", text: str = "text", row: str | None = None,
    item_id: str = "item_id", item_text: str = "text", span: int = 13, gram: int = 5,
) -> DataFrame:
    """(row, id, n_words, n_hit, items) of each document: which of its words stand in a run of
    ``span`` words that a benchmark item has too, and the ids of such items.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Winnowing keeps the
    smallest hash of every ``span`` words on both sides, so each shared run of that length shares a
    fingerprint. Those of the documents pass a filter of fixed size, are joined with those of the items,
    and each is extended to the windows around it, which are compared word by word. Items of fewer words
    than ``span`` must occur whole; they keep fingerprints of their own length. Null and empty texts have
    no words and no hits; an item without words occurs nowhere; a null item id counts as a hit but not as
    an item; items that repeat count once per id; without items nothing is hit; an empty table of
    documents gives no rows. ``row`` names a column of row numbers if there is one. Only
    fingerprints that the benchmark may have leave the scan of the documents.
    """
    spark = docs.sparkSession
    windows = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text"))
    windows = stage(item_windows(windows, span, gram), "windows")
    prints = windows.select("span", "print").distinct()
    lengths = sorted(r.span for r in windows.select("span").distinct().collect())  # at most ``span``
    bits = spark.sparkContext.broadcast(_filter(prints, FILTER_BITS))
    number = F.col(row) if row else F.monotonically_increasing_id()
    texts = docs.select(number.alias("row"), F.col(id).alias("id"), F.col(text).alias("text"))
    marked = stage(seeds(texts, lengths, span, gram, bits), "seeds")
    joined = marked.select("row", F.inline("seeds")).join(prints, ["span", "print"], "left_semi")
    words = F.split("around", " ")
    reached = joined.select("row", "span", "first", words.alias("words")).where(F.size("words") >= F.col("span"))
    starts = F.sequence(F.lit(0), F.size("words") - F.col("span"))
    around = reached.select("row", "span", F.explode(F.transform(starts, lambda i: F.struct(
        (F.col("first") + i).alias("start"), F.array_join(F.slice("words", i + 1, F.col("span")), " ").alias("window"),
    ))).alias("w")).select("row", "span", "w.*").distinct()
    known = windows.select("span", "window").distinct()
    hits = stage(around.join(known, ["span", "window"], "left_semi"), "hits")
    order = Window.partitionBy("row").orderBy("start", "span").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("span")
    new = end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(order), F.lit(0)))
    covered = (
        hits.select("row", "start", "span").withColumn("new", F.greatest(new, F.lit(0)))
        .groupBy("row").agg(F.sum("new").cast("long").alias("n_hit"))
    )
    # The items of a window are one list before they meet the documents, which unite the few different lists they hit.
    lists = windows.where("item IS NOT NULL").groupBy("span", "window").agg(F.array_sort(F.collect_set("item")).alias("items"))
    named = (
        hits.select("row", "span", "window").distinct().join(lists, ["span", "window"])
        .groupBy("row").agg(F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    )
    kind = items.schema[item_id].dataType.simpleString()
    out = marked.select("row", "id", "n_words").join(covered, "row", "left").join(named, "row", "left")
    return out.select(
        "row", "id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast(f"array<{kind}>")).alias("items"),
    )


def is_contaminated(share: int = 20):
    """At least one word in ``share`` is hit."""
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame, *, share: int = 20, **options) -> DataFrame:
    """``docs`` without the contaminated ones. They are written once with a row number."""
    numbered = stage(
        docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"), F.monotonically_increasing_id().alias("row")),
        "documents",
    )
    columns = {"id": options.pop("id", "doc_id"), "text": options.pop("text", "text")}
    flat = numbered.select("row", *(F.col(f"doc.{c}").alias(k) for k, c in columns.items()))
    found = contamination(flat, items, id="id", text="text", row="row", **options)
    # Written first: the planner knows how few they are, and does not move the documents to meet them.
    dropped = stage(found.where(is_contaminated(share)).select("row"), "dropped")
    return numbered.join(dropped, "row", "left_anti").select("doc.*")
