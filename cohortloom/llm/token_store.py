"""Token ids on disk: one zstandard frame per document, under a shared dictionary.

A store is two Parquet tables. ``dictionary`` has one row: hash and bytes. ``blocks``
has rows of consecutive documents in the order of their ids: the hash of the
dictionary, the width of an id, the documents' ids, the offset of each frame, the
number of tokens, and the frames one after the other. A document is read by its
block's range of ids, its offset and the dictionary alone.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cohortloom.llm.common import pieces
from cohortloom.llm.tokens import encoder

END_ID = 0
#: A block ends at so many bytes of frames or so many documents.
BLOCK_BYTES, BLOCK_DOCS = 1 << 20, 4096
#: The dictionary is trained on about so many documents, so many characters of each.
SAMPLE_DOCS, SAMPLE_CHARS, DICTIONARY_BYTES = 1000, 20_000, 112_640
LEVEL = 3


def with_end(ids: np.ndarray) -> np.ndarray:
    return np.append(ids, np.array([END_ID], ids.dtype))


def train_dictionary(docs: DataFrame, path: str, text: str = "text") -> bytes:
    """A dictionary from serialised ids of a bounded sample, chosen by hash; b'' if too few."""
    n = docs.count()
    share = F.pmod(F.xxhash64(text), F.lit(1 << 30)) * n < F.lit(SAMPLE_DOCS << 30)
    sample = docs.where(F.col(text).isNotNull() & share).select(
        F.substring(text, 1, SAMPLE_CHARS).alias("text")).limit(2 * SAMPLE_DOCS)

    def encode(batches):
        own = encoder(path)
        for batch in batches:
            rows = [with_end(ids).tobytes() for ids in own.ids(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["ids"])

    rows = sorted(bytes(r.ids) for r in sample.mapInArrow(encode, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, rows).as_bytes()
    except zstandard.ZstdError:
        return b""


def codec_of(dictionary: bytes):
    held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return (zstandard.ZstdCompressor(level=LEVEL, dict_data=held),
            zstandard.ZstdDecompressor(dict_data=held))


@lru_cache(maxsize=4)
def codec(dictionary: bytes):
    return codec_of(dictionary)


def write_store(docs: DataFrame, folder: str, path: str, *, ident: str = "doc_id",
                text: str = "text") -> None:
    """Encode every row's whole text and write the store, in ascending order of ids.

    A null text is an empty one: its only token is the end id. Null ids come first;
    repeated rows are stored each. An empty table gives a store without blocks. A very
    long text is encoded whole by one task and is one frame. Other columns are not read.
    Without enough texts to train on the dictionary is empty, which its hash shows. Tasks take ranges of ids, so that blocks are in
    order and no document is compressed with its neighbours.
    """
    spark = docs.sparkSession
    frame = docs.select(F.col(ident).alias("ident"), F.col(text).alias("text"))
    dictionary = train_dictionary(frame, path)
    name = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(name, bytearray(dictionary))], "hash string, dictionary binary"
                          ).coalesce(1).write.parquet(f"{folder}/dictionary")
    shared = spark.sparkContext.broadcast(dictionary)
    kind = frame.schema["ident"].dataType
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()),
        T.StructField("dictionary", T.StringType()), T.StructField("width", T.IntegerType()),
        T.StructField("first", kind), T.StructField("last", kind),
        T.StructField("n_tokens", T.LongType()), T.StructField("idents", T.ArrayType(kind)),
        T.StructField("offsets", T.ArrayType(T.LongType())),
        T.StructField("counts", T.ArrayType(T.LongType())),
        T.StructField("frames", T.BinaryType())])

    def pack(batches):
        own, compress = encoder(path), codec(shared.value)[0].compress
        part, block = TaskContext.get().partitionId(), 0
        idents, counts, frames, held = [], [], [], 0

        def row():
            places = np.cumsum([0, *map(len, frames)]).tolist()
            values = [part, block, name, 4 if own.wide else 2, idents[0], idents[-1],
                      sum(counts), list(idents), places, list(counts), b"".join(frames)]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(values, arrow, strict=True)], schema=arrow)

        arrow = None
        for batch in batches:
            if arrow is None:
                own_kind = batch.schema.field(0).type
                arrow = pa.schema([
                    ("part", pa.int32()), ("block", pa.int32()), ("dictionary", pa.string()),
                    ("width", pa.int32()), ("first", own_kind), ("last", own_kind),
                    ("n_tokens", pa.int64()), ("idents", pa.list_(own_kind)),
                    ("offsets", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
                    ("frames", pa.binary())])
            for piece, texts in pieces(batch, "text"):
                found = own.ids([t.decode() if t else "" for t in texts])
                for one, ids in zip(piece.column(0).to_pylist(), found, strict=True):
                    ids = with_end(ids)
                    idents.append(one)
                    counts.append(len(ids))
                    frames.append(compress(ids.tobytes()))
                    held += len(frames[-1])
                    if held >= BLOCK_BYTES or len(idents) >= BLOCK_DOCS:
                        yield row()
                        block, held = block + 1, 0
                        idents, counts, frames = [], [], []
        if idents:
            yield row()

    ordered = frame.repartitionByRange("ident").sortWithinPartitions("ident", "text")
    ordered.mapInArrow(pack, schema).write.option("compression", "none").parquet(
        f"{folder}/blocks")


def stored_dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    return row.hash, bytes(row.dictionary)


def decoded(blocks: DataFrame, dictionary: tuple[str, bytes], fields: list[T.StructField],
            of_ids) -> DataFrame:
    """Rows (part, block, place, ident, n_before, n_tokens, ...): each frame opened alone.

    ``of_ids`` turns the ids of the documents of a block into one array per field.
    """
    name, content = dictionary
    shared = blocks.sparkSession.sparkContext.broadcast(content)
    kind = blocks.schema["first"].dataType
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()),
        T.StructField("ident", kind), T.StructField("n_before", T.LongType()),
        T.StructField("n_tokens", T.LongType()), *fields])

    def read(batches):
        decompress = codec(shared.value)[1].decompress
        for batch in batches:
            kind = batch.schema.field("first").type
            for i in range(batch.num_rows):
                row = {f: batch.column(f)[i] for f in batch.schema.names}
                if row["dictionary"].as_py() != name:
                    raise ValueError("a block was written under another dictionary")
                frames, places = row["frames"].as_buffer(), row["offsets"].as_py()
                view, width = memoryview(frames), row["width"].as_py()
                ids = [np.frombuffer(decompress(view[a:b]), f"<u{width}")
                       for a, b in zip(places[:-1], places[1:], strict=True)]
                sizes = list(map(len, ids))
                before = np.cumsum([0, *sizes])[:-1]
                n = len(ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"].as_py()] * n, pa.int32()),
                    pa.array([row["block"].as_py()] * n, pa.int32()),
                    pa.array(row["idents"].as_py(), kind), pa.array(before, pa.int64()),
                    pa.array(sizes, pa.int64()), *of_ids(ids)], names=schema.names)

    return blocks.select("part", "block", "dictionary", "width", "first", "idents", "offsets",
                         "frames").mapInArrow(read, schema)


def read_index(spark: SparkSession, folder: str, *, ident: str = "doc_id") -> DataFrame:
    """Per stored document, from the files: id, start, n_tokens, ids_crc32.

    start is the number of ids before it: of the parts before, of the blocks before
    in its part, and of the documents before in its block.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    sums = blocks.select("part", "block", "n_tokens")
    parts = sums.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    by_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_block = Window.partitionBy("part").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    # One row per task of the writer, then one per block of it.
    parts = parts.select("part", F.coalesce(F.sum("_n").over(by_part), F.lit(0)).alias("_part"))
    starts = sums.select("part", "block", F.coalesce(
        F.sum("n_tokens").over(by_block), F.lit(0)).alias("_block")).join(parts, "part")
    starts = starts.select("part", "block", (F.col("_part") + F.col("_block")).alias("_start"))

    def check(ids):
        return [pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64())]

    rows = decoded(blocks, stored_dictionary(spark, folder),
                   [T.StructField("ids_crc32", T.LongType())], check)
    return rows.join(starts, ["part", "block"]).select(
        F.col("ident").alias(ident), (F.col("_start") + F.col("n_before")).alias("start"),
        "n_tokens", "ids_crc32")


def read_documents(spark: SparkSession, folder: str, low, high, *, ident: str = "doc_id"
                   ) -> DataFrame:
    """(id, ids) of the documents from ``low`` to ``high``; only blocks in that range are read."""
    blocks = spark.read.parquet(f"{folder}/blocks").where(
        # Null ids stand first, so a block that begins with one may hold any up to its last.
        (F.col("last") >= low) & (F.col("first").isNull() | (F.col("first") <= high)))
    rows = decoded(blocks, stored_dictionary(spark, folder),
                   [T.StructField("ids", T.ArrayType(T.LongType()))],
                   lambda ids: [pa.array([x.astype(np.int64) for x in ids],
                                         pa.list_(pa.int64()))])
    return rows.where(F.col("ident").between(low, high)).select(
        F.col("ident").alias(ident), "ids")
