"""Benchmark decontamination: find every word of a document that stands in a test window.

The normalised windows of the benchmark go to the tasks as a hash set; each task
scans whole documents, hashes every window of words, and compares the hits word by
word. The set is checked before it is sent: beyond ``most_windows`` the benchmark
is cut into parts by window hash and the documents are scanned once per part.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.common import plain_words, text_columns, written

WINDOW = 10
#: Windows sent to the tasks at once: about 200 MB in a worker.
MOST_WINDOWS = 500_000
#: Odd multiplier of the rolling window hash, wrapping at 64 bits.
BASE = np.uint64(0x9E3779B97F4A7C15)

SPANS = T.ArrayType(T.ArrayType(T.IntegerType()))


def window_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    n = len(ids) - length + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(length if n > 0 else 0):
        out = out * BASE + ids[k:k + n]
    return out


class WindowIndex:
    """Test windows by length: hashes to find candidates, words to settle them."""

    def __init__(self, rows: Iterable[tuple[bytes, str]]):
        self.words: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], list[str]] = {}
        for window, item in rows:
            key = tuple(self.words.setdefault(w, len(self.words) + 1) for w in window.split())
            self.items.setdefault(key, []).append(item)
        self.hashes: dict[int, np.ndarray] = {}
        for length in sorted({len(k) for k in self.items}):
            found = np.array([k for k in self.items if len(k) == length], np.uint64)
            self.hashes[length] = np.unique(
                np.concatenate([window_hashes(row, length) for row in found]))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, length, items) of every window that stands in the words."""
        ids = np.fromiter(map(self.words.get, words, repeat(0)), np.uint64, len(words))
        for length, known in self.hashes.items():
            hashes = window_hashes(ids, length)
            place = np.searchsorted(known, hashes)
            place[place == len(known)] = 0
            for i in np.flatnonzero(known[place] == hashes).tolist():
                items = self.items.get(tuple(ids[i:i + length].tolist()))
                if items is not None:
                    yield i, length, items


def merged(spans: Iterable[tuple[int, int]]) -> list[list[int]]:
    """Spans [start, end) as the fewest that cover the same words, in order."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text",
                      size: int = WINDOW) -> DataFrame:
    """Distinct (window, item): ``size`` consecutive words, or all of a shorter text.

    Items without words have none; an item without an id is called ''.
    """
    named = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))

    def prepare():
        def windows(texts):
            rows = []
            for words in map(plain_words, texts):
                n = min(size, len(words)) or 1
                rows.append([b" ".join(words[i:i + n])
                             for i in range(len(words) - n + 1)] if words else [])
            return [pa.array(rows, pa.list_(pa.binary()))]
        return windows

    field = T.StructField("windows", T.ArrayType(T.BinaryType()))
    rows = text_columns(named, "text", [field], prepare, ["item"])
    return rows.select("item", F.explode("windows").alias("window")).distinct()


def scan(docs: DataFrame, text: str, windows: list[tuple[bytes, str]]) -> DataFrame:
    """Adds to the columns _spans and _items of each row what this part of the set finds."""
    shared = docs.sparkSession.sparkContext.broadcast(WindowIndex(windows))
    others = [c for c in docs.columns if c not in ("_spans", "_items", "_n_words")]
    schema = T.StructType([
        *(docs.schema[c] for c in others), T.StructField("_n_words", T.LongType()),
        T.StructField("_spans", SPANS), T.StructField("_items", T.ArrayType(T.StringType()))])

    def prepare():
        index = shared.value

        def find(texts):
            counts, spans, items = [], [], []
            for words in map(plain_words, texts):
                hits = list(index.find(words))
                counts.append(len(words))
                spans.append(merged((i, i + n) for i, n, _ in hits))
                items.append(sorted({x for _, _, own in hits for x in own}))
            return [pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                    pa.array(items, pa.list_(pa.string()))]
        return find

    return text_columns(docs, text, list(schema)[len(others):], prepare, others)


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", size: int = WINDOW,
               most_windows: int = MOST_WINDOWS, carry: tuple[str, ...] = ("doc_id",)
               ) -> DataFrame:
    """Per row of ``docs``: the carried columns, n_words, spans of hit words, item ids.

    Null and empty texts have no words. Repeated rows are scanned each. Without
    benchmark windows nothing is hit; an empty table gives no rows. A very long text
    is scanned whole by one task. Other columns are not read, whatever their names.
    """
    names = [f"in_{i}" for i in range(len(carry))]
    frame = docs.select(*(F.col(c).alias(n) for c, n in zip(carry, names, strict=True)),
                        F.col(text).alias("_text"))
    windows = written(benchmark_windows(benchmark, size=size), "benchmark-windows")
    parts = max(1, -(-windows.count() // most_windows))
    part_of = F.pmod(F.xxhash64("window"), F.lit(parts))
    for part in range(parts):
        own = [(bytes(r.window), r.item) for r in windows.where(part_of == part).collect()]
        found = scan(frame, "_text", own)
        if part:
            # What an earlier part found is united with this part's.
            found = found.withColumns({
                "_spans": F.concat("_spans", "_old_spans"),
                "_items": F.array_union("_items", "_old_items")}).drop("_old_spans", "_old_items")
        if part + 1 < parts:
            found = written(found, "leak-part")
            frame = found.withColumnsRenamed({"_spans": "_old_spans", "_items": "_old_items"})
    return found.select(
        *(F.col(n).alias(c) for c, n in zip(carry, names, strict=True)),
        F.col("_n_words").alias("n_words"), F.col("_spans").alias("spans"),
        F.col("_items").alias("items"))


def hit_words(spans: str) -> F.Column:
    """Number of words in any of the spans, which may overlap when parts were united."""
    flat = F.transform(F.array_sort(F.col(spans)), lambda x: F.struct(
        x[0].alias("start"), x[1].alias("end")))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("sum"))
    return F.aggregate(flat, start, lambda a, x: F.struct(
        F.greatest(a["end"], x["end"]).alias("end"),
        (a["sum"] + F.greatest(x["end"] - F.greatest(a["end"], x["start"]), F.lit(0))
         ).alias("sum")))["sum"]


def leak_report(found: DataFrame) -> DataFrame:
    """n_hit, n_items, the SHA-256 of the sorted item ids and the verdict, beside the carried."""
    items = F.array_join(F.sort_array("items"), ",")
    return found.withColumns({
        "n_hit": hit_words("spans"), "n_items": F.size("items").cast("long"),
        "items_sha256": F.sha2(items, 256)}).withColumn("contaminated", F.col("n_hit") > 0)


WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def without_words(text: bytes, spans: list[list[int]]) -> bytes:
    """The text with the words of each span, and what stands between them, taken out."""
    places = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for start, end in merged(spans):
        out.append(text[at:places[start][0]])
        at = places[end - 1][1]
    return b"".join([*out, text[at:]])


def clean_documents(docs: DataFrame, benchmark: DataFrame, *, text: str = "text",
                    remove: str = "documents", max_hit_share: float = 0.0,
                    size: int = WINDOW, most_windows: int = MOST_WINDOWS) -> DataFrame:
    """``docs`` without what stands in the benchmark, with the columns of ``docs``.

    ``documents`` drops each document whose share of hit words is above
    ``max_hit_share``; ``spans`` keeps every document and takes the hit words out.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    rows = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("_row"),
                       F.col(text).alias("_body"))
    found = find_leaks(rows, benchmark, text="_body", size=size, most_windows=most_windows,
                       carry=("_row", "_body"))
    if remove == "documents":
        return found.where(hit_words("spans") <= max_hit_share * F.col("n_words")).select("_row.*")

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            new = [t if t is None else without_words(t, s).decode()
                   for t, s in zip(texts, batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new, pa.string())],
                                             names=["_row", "_cut"])

    cut = found.select("_row", "_body", "spans")
    schema = T.StructType([cut.schema["_row"], T.StructField("_cut", T.StringType())])
    return cut.mapInArrow(run, schema).select(*(
        F.col("_cut" if c == text else f"_row.`{c}`").alias(c) for c in docs.columns))
