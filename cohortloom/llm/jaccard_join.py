"""N-gram Jaccard join with prefixes of token combinations.

Tokens are hashed shingles in one order, rare ones first. A set of n tokens may
miss m of them and still be similar enough; then the first shared token stands
among its first m + 1. Rare tokens of that prefix are index keys by themselves.
Frequent tokens are dealt to q classes by hash and the prefix is made q longer:
if the first shared token is frequent, so are the q + 1 first shared ones, two of
them fall in one class, and pairs of tokens within a class are the index keys. A
pair of sets takes q from the larger one's size, and a set is indexed for every q
that a partner may ask for.

Equal sets are one node. In a bucket of an index key every node is compared with a
few centres only; what these leave in different components is compared in blocks,
by a bound from bit maps, and then exactly. Of the pairs that a bit map lets through,
a node's nearest go first, and the others only where they still are in different
components then. So a large group of near copies costs pairs in proportion to its
size, and no link between components is lost.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cohortloom.llm.common import pieces, text_columns, written
from cohortloom.llm.components import connected
from cohortloom.llm.spans import word_codes

MIX = np.uint64(0xFF51AFD7ED558CCD)
#: Words whose hashes a task remembers.
MOST_WORDS = 200_000
#: Tasks whose counters meet in one, and levels of that: enough for 16 million tasks, of
#: which the last few hundred strips go to the driver one after the other.
FAN, LEVELS = 64, 4


@dataclass(frozen=True)
class JaccardJoin:
    """``percent``: similarity that links; ``size``: words in a shingle.

    ``sketch_bits``: counters of the document frequencies are 2 to this power.
    ``frequent``: a counter this many times above the mean marks frequent tokens.
    ``map_words``: 64-bit words in a bit map. ``map_bits``: bits for each token at least
    in the maps of candidates, made before their sets are. ``block``: nodes of a bucket
    compared in one block. ``nearest``: pairs of a node in two blocks that are settled in
    a round, until none had more; the round after these takes all. ``most_broadcast``: nodes whose ids are sent to the tasks that
    read their texts; for more of them the texts are shuffled.
    """

    percent: int = 85
    size: int = 4
    sketch_bits: int = 20
    frequent: float = 4.0
    map_words: int = 32
    map_bits: int = 8
    block: int = 512
    nearest: tuple[int, ...] = (4, 32)
    most_broadcast: int = 1_000_000

    def misses(self, n: int) -> int:
        """Tokens that a set of n need not share with a similar one."""
        return n - -(-self.percent * n // 100)

    def partners(self, n: int) -> range:
        """Sizes from n up of the larger set in a similar pair."""
        return range(n, 100 * n // self.percent + 1)

    def classes(self, n: int) -> int:
        return 1 << (max(1, self.misses(n)).bit_length() - 1)

    def words_for(self, n: int) -> int:
        """64-bit words in the map of a candidate of n tokens: map_words, doubled as needed."""
        words = self.map_words
        while 64 * words < self.map_bits * n:
            words *= 2
        return words

    def can_differ(self, n: int) -> bool:
        """Whether a set of n can be similar to another one at all."""
        return 100 * n >= self.percent * (n + 1)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value

    def of_texts(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """The words' hashes of whole texts; those of ``word_codes``, none is remembered."""
        return word_codes(texts)


def ordered_shingles(words: list[bytes] | np.ndarray, size: int, hashes: WordHashes | None = None
                     ) -> np.ndarray:
    """64-bit shingle hashes in the order of the text; none without words.

    ``words`` are hashes of words already, or words to be hashed by ``hashes``."""
    if not len(words):
        return np.empty(0, np.uint64)
    codes = words if hashes is None else np.fromiter(
        map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(codes))
    n = len(codes) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = (out ^ codes[k:k + n]) * MIX
        out ^= out >> np.uint64(32)
    return out


def shingles(codes: np.ndarray, size: int) -> np.ndarray:
    """Distinct 64-bit shingle hashes in ascending order; none without words."""
    return np.unique(ordered_shingles(codes, size))


def token_counts(docs: DataFrame, text: str, rule: JaccardJoin) -> np.ndarray:
    """Document frequencies of all shingles, added up in a fixed number of counters.

    Every document is counted. Each task adds its own up first; the counters travel
    in 64 strips, which are summed in levels of ``FAN`` tasks at most.
    """
    bits, strips = rule.sketch_bits, 64
    whole = T.StructType([T.StructField("strip", T.IntegerType()), T.StructField("task", T.LongType()),
                          T.StructField("counts", T.ArrayType(T.LongType()))])

    def count(batches):
        total, task = np.zeros(1 << bits, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            for _, texts in pieces(batch, text):
                for start in range(0, len(texts), 512):
                    sets = [shingles(c, rule.size) for c in word_codes(texts[start:start + 512])]
                    at = (np.concatenate(sets) >> np.uint64(64 - bits)).astype(np.int64)
                    total += np.bincount(at, minlength=1 << bits)
        rows = total.reshape(strips, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(strips), pa.int32()), pa.array([task] * strips, pa.int64()),
             pa.array(list(rows), pa.list_(pa.int64()))], names=whole.names)

    def add(strip: pa.Table) -> pa.Table:
        rows = strip.column("counts").combine_chunks()
        total = np.asarray(rows.values).reshape(len(rows), -1).sum(0)
        return pa.table({"strip": strip.column("strip").slice(0, 1),
                         "task": pa.array([strip.column("task")[0].as_py() // FAN], pa.int64()),
                         "counts": pa.array([total], pa.list_(pa.int64()))})

    summed = docs.select(text).mapInArrow(count, whole)
    for _ in range(LEVELS):
        summed = summed.groupBy("strip", F.floor(F.col("task") / FAN)).applyInArrow(add, whole)
    out = np.zeros((strips, (1 << bits) // strips), np.int64)
    for row in summed.toLocalIterator():
        out[row.strip] += row.counts
    return out.reshape(-1)


def index_keys(tokens: np.ndarray, counts: np.ndarray, limit: float, rule: JaccardJoin
               ) -> np.ndarray:
    """The keys a set of tokens is indexed by."""
    n = len(tokens)
    if not rule.can_differ(n):
        return np.empty(0, np.uint64)
    order = np.lexsort((tokens, counts))
    tokens, often = tokens[order], counts[order] > limit
    misses = rule.misses(n)
    rare = tokens[:misses + 1][~often[:misses + 1]]
    keys = [rare]
    first = int(often.argmax()) if often.any() else n
    for q in sorted({rule.classes(s) for s in rule.partners(n)}):
        row = tokens[first:misses + q + 1]
        if len(row) < 2:
            continue
        own = row % np.uint64(q)
        place = np.argsort(own, kind="stable")
        row, own = row[place], own[place]
        for step in range(1, len(row)):
            same = own[step:] == own[:-step]
            if not same.any():
                break
            pair = (row[:-step][same] * MIX) ^ row[step:][same]
            keys.append((pair ^ np.uint64(q)) * MIX)
    return np.unique(np.concatenate(keys))


def bit_map(tokens: np.ndarray, words: int) -> bytes:
    bits = np.zeros(words * 64, np.uint8)
    bits[((tokens * MIX) >> np.uint64(40)).astype(np.int64) % len(bits)] = 1
    return np.packbits(bits).tobytes()


def indexed(docs: DataFrame, text: str, carry: list[str], rule: JaccardJoin) -> DataFrame:
    """Per row: carried columns, n_shingles, digest of the set (null without words), keys, map."""
    counts = token_counts(docs, text, rule)
    limit = rule.frequent * counts.mean() + 32
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    shift = np.uint64(64 - rule.sketch_bits)

    def prepare():
        often = shared.value

        def compute(texts):
            sizes, digests, keys, maps = [], [], [], []
            for codes in word_codes(texts):
                tokens = shingles(codes, rule.size)
                sizes.append(len(tokens))
                digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
                               if len(tokens) else None)
                at = often[(tokens >> shift).astype(np.int64)]
                keys.append(index_keys(tokens, at, limit, rule).view(np.int64))
                maps.append(bit_map(tokens, rule.map_words) if len(keys[-1]) else None)
            return [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())), pa.array(maps, pa.binary())]
        return compute

    fields = [T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.BinaryType()),
              T.StructField("keys", T.ArrayType(T.LongType())),
              T.StructField("map", T.BinaryType())]
    return text_columns(docs, text, fields, prepare, carry)


def near_pairs(pairs: DataFrame, nodes: DataFrame, rule: JaccardJoin) -> DataFrame:
    """The pairs (a, b) that sizes and bit maps do not rule out."""
    sides = [nodes.select(F.col("node").alias(c), F.col("n_shingles").alias(f"{c}_size"),
                          F.col("map").alias(f"{c}_map")) for c in ("a", "b")]
    both = pairs.join(sides[0], "a").join(sides[1], "b").select(
        "a", "b", "a_size", "b_size", "a_map", "b_map")

    def run(batches):
        for batch in batches:
            a, b = (batch.column(c).to_numpy() for c in ("a_size", "b_size"))
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64
                                         ).reshape(len(a), -1) for c in ("a_map", "b_map"))
            apart = np.bitwise_count(left ^ right).sum(1, dtype=np.int64)
            near = may_be_similar(a, b, apart, rule)
            yield pa.RecordBatch.from_arrays(
                [pc.filter(batch.column(c), pa.array(near)) for c in ("a", "b")], names=["a", "b"])

    return both.mapInArrow(run, "a bigint, b bigint")


def may_be_similar(a: np.ndarray, b: np.ndarray, apart: np.ndarray, rule: JaccardJoin
                   ) -> np.ndarray:
    """By sizes and differing bits, of which there are at most |a u b| - |a n b|."""
    return (100 * np.minimum(a, b) >= rule.percent * np.maximum(a, b)) & (
        (100 + rule.percent) * apart <= (100 - rule.percent) * (a + b))


def differing(left: bytes, right: bytes) -> int:
    """Differing bits of two maps; the longer one is folded to the shorter one's length."""
    a, b = sorted((np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)), key=len)
    return int(np.bitwise_count(a ^ np.bitwise_or.reduce(b.reshape(-1, len(a)))).sum(dtype=np.int64))


def of_candidates(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, rule: JaccardJoin,
                  name: str, fields: list[T.StructField], compute) -> DataFrame:
    """node and ``fields`` of the pairs' nodes, made from the shingles of their texts."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = written(wanted.join(nodes.select("node", "ident", "text_hash"), "node"),
                     "jaccard-wanted").withColumnsRenamed({"ident": "_ident", "text_hash": "_hash"})
    if wanted.count() <= rule.most_broadcast:
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, F.col("ident").eqNullSafe(F.col("_ident")) & (
        F.col("text_hash") == F.col("_hash"))).select("node", "_text")

    def prepare():
        return lambda own: compute([shingles(c, rule.size) for c in word_codes(own)])

    return written(text_columns(texts, "_text", fields, prepare, ["node"]).dropDuplicates(["node"]),
                   name)


def near_candidates(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, rule: JaccardJoin
                    ) -> DataFrame:
    """The pairs (a, b) that maps as large as their sets ask for do not rule out."""
    maps = of_candidates(
        pairs, docs, nodes, rule, "jaccard-maps",
        [T.StructField("size", T.LongType()), T.StructField("map", T.BinaryType())],
        lambda sets: [pa.array(list(map(len, sets)), pa.int64()),
                      pa.array([bit_map(s, rule.words_for(len(s))) for s in sets], pa.binary())])
    sides = [maps.select(F.col("node").alias(c), F.col("size").alias(f"{c}_size"),
                         F.col("map").alias(f"{c}_map")) for c in ("a", "b")]
    both = pairs.join(sides[0], "a").join(sides[1], "b").select(
        "a", "b", "a_size", "b_size", "a_map", "b_map")

    def run(batches):
        for batch in batches:
            a, b = (batch.column(c).to_numpy() for c in ("a_size", "b_size"))
            apart = np.fromiter((differing(x.as_py(), y.as_py()) for x, y in zip(
                batch.column("a_map"), batch.column("b_map"), strict=True)), np.int64, len(a))
            near = may_be_similar(a, b, apart, rule)
            yield pa.RecordBatch.from_arrays(
                [pc.filter(batch.column(c), pa.array(near)) for c in ("a", "b")], names=["a", "b"])

    return both.mapInArrow(run, "a bigint, b bigint")


def similar(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, rule: JaccardJoin) -> DataFrame:
    """The pairs (a, b) whose sets are similar, by the sets of their texts, read again.

    Maps by size go first: they take an eighth of a set's bytes or little more, and few
    sets of long texts that are not similar have to meet after them."""
    pairs = written(near_candidates(pairs, docs, nodes, rule), "jaccard-near")
    sets = of_candidates(
        pairs, docs, nodes, rule, "jaccard-sets",
        [T.StructField("tokens", T.ArrayType(T.LongType(), False))],
        lambda sets: [pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))])
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("_left"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("_right"))
    both = pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.size("_left").alias("_l"), F.size("_right").alias("_r"),
        F.size(F.array_intersect("_left", "_right")).alias("_both"))
    return both.where(100 * F.col("_both") >= rule.percent * (
        F.col("_l") + F.col("_r") - F.col("_both"))).select("a", "b")


def near_in_block(rule: JaccardJoin, most: int | None):
    """Reads rows sorted by (key, left, right, node); yields the pairs their bit maps do not
    rule out, with ``most`` a node's nearest ones, and the keys that may have more."""
    def pairs_of(rows: pa.Table):
        same = rows.column("left")[0] == rows.column("right")[0]
        node, size, part = (rows.column(c).to_numpy() for c in ("node", "size", "part"))
        in_left = rows.column("block").to_numpy() == rows.column("left")[0].as_py()
        maps = np.frombuffer(b"".join(rows.column("map").to_pylist()), np.uint64)
        maps = maps.reshape(len(node), -1)
        for i in np.flatnonzero(in_left).tolist():
            others = np.flatnonzero((part != part[i]) & (
                np.arange(len(node)) > i if same else ~in_left))
            apart = np.bitwise_count(maps[others] ^ maps[i]).sum(1, dtype=np.int64)
            near = may_be_similar(size[others], size[i], apart, rule)
            others, apart = others[near], apart[near]
            if len(others):
                cut = most is not None and len(others) > most
                if cut:
                    others = others[np.lexsort((node[others], apart))[:most]]
                yield np.minimum(node[others], node[i]), np.maximum(node[others], node[i]), cut

    def run(batches):
        held: list[pa.RecordBatch] = []

        def flush(table):
            found, names = list(pairs_of(table)), ["key", "a", "b"]
            if found:
                a, b = (pa.array(np.concatenate([f[k] for f in found])) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.int64()), a, b], names=names)
            if most is not None and (table.column("left")[0].as_py() >= 0 or any(
                    cut for _, _, cut in found)):
                none = pa.nulls(1, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [table.column("key").slice(0, 1).combine_chunks(), none, none], names=names)

        def edges_of(table):
            keys = [table.column(c).to_numpy() for c in ("key", "left", "right")]
            change = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
            return [0, *change.tolist(), table.num_rows]

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch])
            marks = edges_of(table)
            for start, end in zip(marks[:-2], marks[1:-1], strict=True):
                yield from flush(table.slice(start, end - start))
            held = table.slice(marks[-2]).to_batches()
        if held:
            yield from flush(pa.Table.from_batches(held))

    return run


def left_over(members: DataFrame, parts: DataFrame, nodes: DataFrame, rule: JaccardJoin,
              most: int | None = None) -> DataFrame:
    """Pairs (a, b) of nodes in one bucket but different components that may be similar.

    A large bucket's nodes outside its largest component are dealt to blocks by hash,
    and so are those inside; blocks meet in pairs, except two of the second kind.
    With ``most``, a node's nearest ones of two blocks, and a block outside meets itself and
    one inside. Rows with a key and no pair name the buckets that may have more.
    """
    part = F.coalesce(F.col("component"), F.col("node"))
    placed = members.select("key", "node").join(parts, "node", "left").select(
        "key", "node", part.alias("part"))
    sizes = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("_n"))
    open_keys = sizes.groupBy("key").agg(
        F.max_by("part", F.struct("_n", "part")).alias("_head"), F.max("_n").alias("_inside"),
        F.sum("_n").alias("_all")).where("_inside < _all")
    blocks = lambda rows: F.ceil(rows / rule.block).cast("int")
    placed = placed.join(open_keys, "key").select(
        "key", "node", "part", (F.col("part") != F.col("_head")).alias("_out"),
        (F.col("_all") <= rule.block).alias("_whole"),
        blocks(F.col("_all") - F.col("_inside")).alias("_outs"), blocks(F.col("_inside")).alias("_ins"))
    # A bucket of one block, -1, is compared whole; in a larger one the first blocks are those
    # outside the largest component, the others those inside.
    whole, out, outs, ins = (F.col(c) for c in ("_whole", "_out", "_outs", "_ins"))
    own = F.xxhash64("node")
    block = F.when(whole, F.lit(-1)).when(out, F.pmod(own, outs).cast("int")).otherwise(
        outs + F.pmod(own, ins).cast("int"))
    if most is None:
        others = F.when(out, F.sequence(F.lit(0), outs + ins - 1)).otherwise(
            F.sequence(F.lit(0), outs - 1))
    else:
        others = F.when(out, F.array("block", outs + F.pmod("block", ins))).otherwise(F.filter(
            F.sequence(F.lit(0), outs - 1), lambda i: F.pmod(i, ins) == F.col("block") - outs))
    rows = placed.withColumn("block", block).select(
        "key", "node", "part", "block",
        F.explode(F.when(whole, F.array(F.lit(-1))).otherwise(others)).alias("_other"))
    rows = rows.select("key", "node", "part", "block", F.least("block", "_other").alias("left"),
                       F.greatest("block", "_other").alias("right"))
    rows = rows.join(nodes.select("node", F.col("n_shingles").alias("size"), "map"), "node")
    sorted_rows = rows.repartition("key", "left", "right").sortWithinPartitions(
        "key", "left", "right", "node")
    return sorted_rows.mapInArrow(near_in_block(rule, most), "key bigint, a bigint, b bigint"
                                  ).distinct()


def link_documents(docs: DataFrame, rule: JaccardJoin | None = None, *, ident: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """Per row of ``docs``: the id, text_hash, n_shingles, component_id, component.

    component_id is the smallest id in the component of the row's set; where ids are
    null or repeated, components share it. component differs between any two. A null, empty
    or blank text has no shingles, links with nothing, keeps its own id and is in no
    component. Repeated
    rows and texts with equal sets are one node. An empty table gives no rows. A very long
    text's shingles are made whole by one task. Other columns are not read. The links
    themselves are not returned, only what they connect. Shingles are compared by 64-bit hashes.
    """
    rule = rule or JaccardJoin()
    spark = docs.sparkSession
    frame = docs.select(F.col(ident).alias("ident"), F.col(text).alias("_text"),
                        F.xxhash64(F.col(text)).alias("text_hash"))
    rows = indexed(frame, "_text", ["ident", "text_hash"], rule)
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "jaccard-index")

    classes = rows.where("digest is not null").groupBy("digest").agg(
        F.min("row").alias("node"), F.min("ident").alias("label"))
    nodes = rows.where("size(keys) > 0").join(
        classes.select(F.col("node").alias("row")), "row").withColumnRenamed("row", "node")
    postings = nodes.select("node", F.explode("keys").alias("key"))
    # Few columns while every key is there; the other centres follow for shared keys only.
    buckets = postings.groupBy("key").agg(
        F.count(F.lit(1)).alias("_n"), F.min("node").alias("centre")).where("_n > 1")
    members = written(postings.join(buckets, "key").select("key", "node", "centre"),
                      "jaccard-members")
    named = members.select("node").distinct().join(
        rows.select(F.col("row").alias("node"), "ident", "text_hash", "n_shingles", "map"), "node")
    named = written(named, "jaccard-nodes")

    # Keys with the same nodes are one bucket; count, xor and sum of node hashes tell them.
    mixed = F.xxhash64("node")
    some = F.min(F.struct(mixed.alias("h"), "node"))["node"]
    centres = members.groupBy("key").agg(
        F.array(F.min("node"), F.max("node"), some).alias("_centres"),
        F.count(F.lit(1)).alias("_n"), F.bit_xor(mixed).alias("_xor"),
        F.sum(F.shiftright(mixed, 16)).alias("_sum"))
    centres = centres.dropDuplicates(["_centres", "_n", "_xor", "_sum"])
    members = written(members.join(centres.select("key", "_centres"), "key"), "jaccard-buckets")
    stars = members.select("node", F.explode("_centres").alias("_centre")).where("node != _centre")
    stars = stars.select(F.least("node", "_centre").alias("a"),
                         F.greatest("node", "_centre").alias("b")).distinct()
    pairs = written(near_pairs(stars, named, rule), "jaccard-pairs")
    links = written(similar(pairs, frame, named, rule), "jaccard-links")
    for most in (*rule.nearest, None):
        joined = written(connected(links), "jaccard-parts")
        left = written(left_over(members, joined, named, rule, most), "jaccard-pairs")
        more = written(similar(left.where("a is not null").select("a", "b"), frame, named, rule),
                       "jaccard-links")
        links = more.unionByName(joined.select(F.col("node").alias("a"), F.col("component").alias("b")))
        again = left.where("a is null").select("key")
        if again.isEmpty():
            break
        members = written(members.join(again, "key", "left_semi"), "jaccard-buckets")
    joined = connected(links)

    labels = classes.join(joined, "node")
    least = labels.groupBy("component").agg(F.min("label").alias("component_id"))
    of_class = labels.join(least, "component").select("digest", "component_id", "component")
    lone = classes.join(of_class, "digest", "left").select(
        "digest", F.coalesce("component_id", "label").alias("component_id"),
        F.coalesce("component", "node").alias("component"))
    return rows.join(lone, "digest", "left").select(
        F.col("ident").alias(ident), "text_hash", "n_shingles",
        F.when(F.col("digest").isNull(), F.col("ident")).otherwise(F.col("component_id"))
        .alias("component_id"), "component")


def keep_one_each(docs: DataFrame, rule: JaccardJoin | None = None, *, ident: str = "doc_id",
                  text: str = "text", by: str = "component_id") -> DataFrame:
    """``docs`` with one row of each ``by``: the one with the smallest id, null after others.

    Of equal ids the smallest text hash stays, and of equal rows one. Rows without
    words all stay. component_id takes unlinked rows for one if their ids are null or
    equal; component keeps one row of each of them.
    """
    linked = link_documents(docs, rule, ident=ident, text=text)
    least = F.min(F.struct(F.col(ident).isNull(), F.col(ident).alias("id"), "text_hash"))
    # The id as a struct is never null, so plain equality does, and the join and the turns
    # share one shuffle of the rows.
    keys = ["_id", "_text_hash"]
    first = linked.where("n_shingles > 0").groupBy(by).agg(least.alias("_least")).select(
        F.struct("_least.id").alias("_id"), F.col("_least.text_hash").alias("_text_hash"))
    keyed = docs.select(
        F.struct(*(F.col(c) for c in docs.columns)).alias("_row"),
        F.struct(F.col(ident).alias("id")).alias("_id"), F.xxhash64(F.col(text)).alias("_text_hash"),
        F.coalesce(F.length(F.btrim(F.col(text), F.lit(" \t\n\x0b\x0c\r"))) > 0, F.lit(False))
        .alias("_has_words"))
    kept = keyed.where("_has_words").join(first, keys)
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    kept = kept.withColumn("_turn", turn).where("_turn = 1").select("_row")
    return kept.unionByName(keyed.where("not _has_words").select("_row")).select("_row.*")
