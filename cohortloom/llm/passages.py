"""Repeated passages, removed by hashing the units of lines and windows of words.

A line is cut into units at the ends of sentences. The digests of normalised units are
grouped over all documents; the earliest occurrence stays. A passage that starts or ends
inside a sentence is met by its windows of words: equal windows have equal least anchors, so
only the windows whose own least anchor is repeated are looked at. Those of one anchor are a
block. Equal blocks are grouped first; one window is a row of its own only where an anchor has
different blocks, and there only in the first of each.
Words of repeated units and windows go in runs; a run of a few words and bytes stays, so
that single short sentences which many documents share do.
"""

from __future__ import annotations

import re
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.common import pieces, text_columns, written
from cohortloom.llm.jaccard_join import ordered_shingles
from cohortloom.llm.spans import word_codes

#: Ends a unit: a line break, or white space after the end of a sentence.
UNIT_END = re.compile(rb"\n|(?<=[.!?])[ \t\r]+")
#: A run of repeated words goes if it has so many words, or so many bytes.
MIN_WORDS, MIN_BYTES = 4, 24
#: Words in a window and in an anchor. Of the anchors of a window, the least one is taken.
WINDOW, ANCHOR = 20, 8
#: Bytes that bytes.split() takes as white space.
BLANK = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def units_of(text: bytes) -> list[tuple[int, int, int, int]]:
    """(start, end, words, digest) of every unit with a word; places are bytes of the text."""
    out, cuts = [], [(0, 0), *(m.span() for m in UNIT_END.finditer(text)), (len(text),) * 2]
    for (_, start), (end, _) in pairwise(cuts):
        words = text[start:end].lower().split()
        if words:
            digest = xxhash.xxh3_64_intdigest(b" ".join(words))
            out.append((start, end, len(words), digest))
    return out


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and end byte of every word between white space."""
    blank = np.concatenate([[True], BLANK[np.frombuffer(text, np.uint8)], [True]])
    return np.flatnonzero(blank[:-1] & ~blank[1:]), np.flatnonzero(~blank[:-1] & blank[1:])


def least_anchors(each: np.ndarray) -> np.ndarray:
    """Per window the first word of its least anchor, by the hashes of all anchors of a text."""
    if len(each) < WINDOW - ANCHOR + 1:
        return np.empty(0, np.int64)
    own = np.lib.stride_tricks.sliding_window_view(each, WINDOW - ANCHOR + 1)
    return own.argmin(1) + np.arange(len(own))


def anchors_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the least anchor of every window; equal windows have equal ones."""
    if len(codes) < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    each = ordered_shingles(codes, ANCHOR)
    at = np.unique(least_anchors(each))
    return at, each[at]


def windows_at(codes: np.ndarray, anchors: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the windows whose least anchor is one of those."""
    at, _, _, windows = blocks_at(codes, anchors, alone=True)
    return at, windows


def blocks_at(codes: np.ndarray, anchors: list[int], alone: bool = False
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word, anchor's hash, number of windows) of the blocks of windows whose least anchor
    is one of those, or of these windows ``alone``; the hashes of all windows one after the other."""
    if len(codes) < WINDOW:
        none = np.empty(0, np.int64)
        return none, none.view(np.uint64), none, none.view(np.uint64)
    each = ordered_shingles(codes, ANCHOR)
    wanted, least = np.zeros(len(each), bool), least_anchors(each)
    wanted[anchors] = True
    at = np.flatnonzero(wanted[least])
    own = least[at]
    # Windows of one anchor follow each other.
    firsts = np.arange(len(at)) if alone else np.flatnonzero(np.diff(own, prepend=-1))
    return (at[firsts], each[own[firsts]], np.diff(firsts, append=len(at)),
            ordered_shingles(codes, WINDOW)[at])


def unit_table(docs: DataFrame, carry: list[str], text: str) -> DataFrame:
    def prepare():
        def lists(rows, kind):
            offsets = pa.array(np.cumsum([0, *map(len, rows)]), pa.int32())
            flat = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
            return pa.ListArray.from_arrays(offsets, pa.array(flat).cast(kind))

        def compute(texts):
            units = [np.array([u[3] for u in units_of(t or b"")], np.uint64).view(np.int64)
                     for t in texts]
            found = [anchors_of(c) for c in word_codes(texts)]
            return [lists(units, pa.int64()), lists([f[0] for f in found], pa.int32()),
                    lists([f[1].view(np.int64) for f in found], pa.int64())]
        return compute

    ints, longs = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
    fields = [T.StructField("digests", longs), T.StructField("anchor_places", ints),
              T.StructField("anchors", longs)]
    return text_columns(docs, text, fields, prepare, carry)


def runs(text: bytes, units: list[int], windows: list[int],
         min_words: int = MIN_WORDS, min_bytes: int = MIN_BYTES) -> list[list[int]]:
    """[start, end, words] of each run of repeated words that is long enough.

    ``units`` are places of repeated units; ``windows`` are pairs of the first and the
    end word that go with a repeated window, one after the other.
    """
    starts, ends = word_places(text)
    gone = np.zeros(len(starts) + 1, np.int64)
    if units:
        # A unit has whole words, since it ends at a blank.
        cuts = np.array([(0, 0), *(m.span() for m in UNIT_END.finditer(text)), (len(text),) * 2])
        first, last = np.searchsorted(starts, cuts[:-1, 1]), np.searchsorted(starts, cuts[1:, 0])
        own = np.flatnonzero(last > first)[units]
        np.add.at(gone, first[own], 1)
        np.add.at(gone, last[own], -1)
    if windows:
        np.add.at(gone, windows[::2], 1)
        np.add.at(gone, windows[1::2], -1)
    marked = np.concatenate([[False], np.cumsum(gone[:-1]) > 0, [False]])
    out = []
    for first, end in zip(np.flatnonzero(~marked[:-1] & marked[1:]).tolist(),
                          np.flatnonzero(marked[:-1] & ~marked[1:]).tolist(), strict=True):
        span = [int(starts[first]), int(ends[end - 1]), end - first]
        if span[2] >= min_words or span[1] - span[0] >= min_bytes:
            out.append(span)
    return out


def shared_digests(places: DataFrame) -> DataFrame:
    """Digests of more than one occurrence, and the row and place of the first by (id, row, place)."""
    return places.groupBy("digest").agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct("ident", "row", "place")).alias("_first")
    ).where("_n > 1").select("digest", F.col("_first.row").alias("_row"),
                             F.col("_first.place").alias("_place"))


def repeats_of(places: DataFrame) -> DataFrame:
    """All occurrences but the first of every digest: digest, row, place, _row, _place of the first."""
    return places.join(written(shared_digests(places), "passage-shared"), "digest").where(
        (F.col("row") != F.col("_row")) | (F.col("place") != F.col("_place")))


def block_table(rows: DataFrame) -> DataFrame:
    """ident, row, place, anchor, windows of every block whose anchor is repeated."""
    places = rows.select("row", F.explode(F.arrays_zip("anchor_places", "anchors")).alias("_a")
                         ).select("row", F.col("_a.anchor_places").alias("place"),
                                  F.col("_a.anchors").alias("digest"))
    shared = places.groupBy("digest").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    # Stored, so that the anchors' shuffle is gone before the texts are shuffled.
    wanted = written(places.join(shared, "digest").groupBy("row").agg(
        F.collect_list("place").alias("_anchors")), "passage-anchors")
    texts = rows.select("row", "ident", "_text").join(wanted, "row").select(
        "row", "ident", "_text", "_anchors")
    schema = T.StructType([texts.schema["row"], texts.schema["ident"],
                           T.StructField("place", T.IntegerType()),
                           T.StructField("anchor", T.LongType()),
                           T.StructField("windows", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch in batches:
            for part, own in pieces(batch, "_text") if batch.num_rows else ():
                anchors = part.column(3)
                found = [blocks_at(c, anchors[i].values.to_numpy())
                         for i, c in enumerate(word_codes(own))]
                places, hashes, sizes, windows = map(np.concatenate, zip(*found, strict=True))
                rows = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(rows), part.column(1).take(rows),
                     pa.array(places.astype(np.int32)), pa.array(hashes.view(np.int64)),
                     pa.ListArray.from_arrays(offsets, pa.array(windows.view(np.int64)))],
                    names=schema.names)

    return texts.mapInArrow(run, schema)


def repeated_windows(blocks: DataFrame) -> DataFrame:
    """row, _from, _to: the words that go with repeated windows, by first and end word.

    A block goes whole if an equal one stands before it: its windows stand there too. All
    windows of an anchor are in its blocks, so the first of equal blocks is whole too if
    the anchor has no other ones, and else the first ones' windows are grouped. So are
    those of equal blocks in the first one's row, since a window that overlaps its own first
    occurrence leaves that one whole.
    """
    blocks = blocks.withColumn("block", F.xxhash64("windows"))
    classes = written(blocks.groupBy("anchor", "block").agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct("ident", "row", "place")).alias("_first")
    ).select("anchor", "block", "_n", F.col("_first.row").alias("_row"),
             F.col("_first.place").alias("_place")), "passage-classes")
    some = classes.groupBy("anchor").agg((F.count(F.lit(1)) > 1).alias("_many"))
    known = classes.join(some, "anchor").where("_n > 1 or _many").drop("_n")
    single = F.col("_many") & (F.col("row") == F.col("_row"))
    members = written(blocks.join(known, ["anchor", "block"]).select(
        "ident", "row", "place", "_row", "_place", F.size("windows").alias("_size"),
        F.when(single, F.col("windows")).alias("windows")), "passage-members")

    first = F.when(F.col("row") == F.col("_row"), F.greatest(
        F.col("place"), F.col("_place") + WINDOW)).otherwise(F.col("place"))
    whole = members.where("windows is null and (row != _row or place != _place)").select(
        "row", first.alias("_from"), (F.col("place") + F.col("_size") - 1 + WINDOW).alias("_to"))
    windows = members.where("windows is not null").select(
        "ident", "row", "place", F.posexplode("windows").alias("_step", "digest")).select(
        "ident", "row", (F.col("place") + F.col("_step")).alias("place"), "digest")
    each = repeats_of(windows).select(
        "row", first.alias("_from"), (F.col("place") + WINDOW).alias("_to"))
    return whole.unionByName(each)


def found_repeats(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """Per row of ``docs``: ident, text_hash, n_units, _units, _windows, _text."""
    frame = docs.select(F.col(ident).alias("ident"), F.xxhash64(F.col(text)).alias("text_hash"),
                        F.col(text).alias("_text"))
    rows = written(unit_table(frame, ["ident", "text_hash", "_text"], "_text").withColumn(
        "row", F.monotonically_increasing_id()), "passage-units", codec="zstd")
    units = repeats_of(rows.select("ident", "row", F.posexplode("digests").alias(
        "place", "digest"))).groupBy("row").agg(F.collect_list("place").alias("_units"))
    windows = repeated_windows(written(block_table(rows), "passage-blocks")).groupBy("row").agg(
        F.flatten(F.collect_list(F.array("_from", "_to"))).alias("_windows"))
    units, windows = written(units, "passage-gone"), written(windows, "passage-gone")
    return rows.select("row", "ident", "text_hash", F.size("digests").cast("long").alias("n_units"),
                       "_text").join(units, "row", "left").join(windows, "row", "left").drop("row")


def find_repeats(docs: DataFrame, *, ident: str = "doc_id", text: str = "text",
                 min_words: int = MIN_WORDS, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Per row of ``docs``: id, text_hash, n_units, n_repeated, spans of what may go.

    The columns of ``remove_repeats``, which tells the rules, without the texts.
    """
    return remove_repeats(docs, ident=ident, text=text, min_words=min_words, min_bytes=min_bytes
                          ).select(ident, "text_hash", "n_units", "n_repeated", "spans")


def cut(text: bytes, spans: list[list[int]]) -> bytes:
    out, at = [], 0
    for start, end, _ in spans:
        out.append(text[at:start])
        at = end
    return b"".join([*out, text[at:]])


def remove_repeats(docs: DataFrame, *, ident: str = "doc_id", text: str = "text",
                   min_words: int = MIN_WORDS, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Per row: id, text_hash, n_units, n_repeated, removed_words, spans, text without the spans.

    Occurrences of a unit, and of a window of words at any place, rank by (id, row,
    place); all but the first are repeats, in the same document too. spans are
    [start, end, words] with places in the bytes of the original text. A run of
    fewer than ``min_words`` words and ``min_bytes`` bytes stays. A text that goes
    altogether is left as ''; a null one stays null. Null and empty texts have no
    units. A very long text is cut whole by one task, and its units and windows are
    rows like all others. Of equal rows the first stored one keeps its units. An empty table gives
    no rows. Units and windows are compared by 64-bit hashes.
    """
    found = found_repeats(docs, ident, text).select(
        "ident", "text_hash", "n_units", "_units", "_windows", "_text")
    schema = T.StructType([
        *(found.schema[c] for c in ("ident", "text_hash", "n_units")),
        T.StructField("n_repeated", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("kept_text", T.StringType())])

    def run(batches):
        for batch in batches:
            units, windows = (batch.column(k).to_pylist() for k in (3, 4))
            texts = batch.column(5).cast(pa.binary()).to_pylist()
            spans = [runs(t, u or [], w or [], min_words, min_bytes) if u or w else []
                     for t, u, w in zip(texts, units, windows, strict=True)]
            new = [t if t is None else cut(t, s) for t, s in zip(texts, spans, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([len(u or []) for u in units], pa.int64()),
                 pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                 pa.array(new, pa.binary()).cast(pa.string())], names=schema.names)

    return found.mapInArrow(run, schema).withColumn(
        "removed_words", F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s[2])
    ).withColumnRenamed("ident", ident)
