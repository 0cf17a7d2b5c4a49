"""Ranked lexical search: the best documents of each query, by branch and bound over trees.

A document is restricted to the terms of the queries. Its terms stand in the order of
their document frequency, so documents with the same common terms share a path of a
tree. Each subtree knows the largest count of every term and the smallest length
factor below it, which bounds the score of all its documents; the search of an item
goes depth first into the subtree with the best bound and leaves out what can no
longer reach its ten best.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.common import plain_words, text_columns, written

TOP = 10
#: (item, term) pairs sent to the tasks at once; more items are searched in parts.
MOST_PAIRS = 500_000
#: Cells of one tree, documents times terms: 64 MB of counts.
CELLS = 16_000_000
#: Documents that are scored together at the end of a path.
LEAF = 32
#: Parts in which the best rows of one item are first reduced.
SALTS = 64


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def parts_of_score(counts: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """How far each count saturates: grows with the count, falls with the length factor."""
    return (1_000_000_000 * counts) // (1000 * counts + 8 * factor[:, None])


class DocumentTree:
    """Documents of one task under shared paths of their terms.

    ``rows``, ``columns`` and ``counts`` are the cells of the documents' term vectors;
    columns are numbered by falling document frequency. A node is a range of the
    documents in path order; nodes are kept in order of depth-first first visit.
    """

    def __init__(self, ids: np.ndarray, factor: np.ndarray, rows: np.ndarray,
                 columns: np.ndarray, counts: np.ndarray, width: int, leaf: int = LEAF):
        order = np.lexsort((columns, rows))
        rows, columns, counts = rows[order], columns[order], counts[order]
        ends = np.searchsorted(rows, np.arange(len(ids) + 1))
        big = columns.astype(">u4")
        paths = [big[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        self.order = np.array(sorted(range(len(ids)), key=paths.__getitem__), np.int64)
        self.paths = [paths[i] for i in self.order]
        self.ids, self.factor = ids[self.order], factor[self.order]
        place = np.empty(len(ids), np.int64)
        place[self.order] = np.arange(len(ids))
        self.counts = np.zeros((width, len(ids)), np.int32)
        self.counts[columns, place[rows]] = counts
        self.leaf = leaf
        self.spans: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self._grow()
        self._bound()

    def _shared(self, start: int, end: int) -> int:
        """Number of terms on the common path of a range, in bytes of the path."""
        first, last = self.paths[start], self.paths[end - 1]
        n = min(len(first), len(last))
        if first[:n] == last[:n]:
            return n
        a, b = np.frombuffer(first[:n], ">u4"), np.frombuffer(last[:n], ">u4")
        return 4 * int(np.argmax(a != b))

    def _grow(self) -> None:
        """Cut ranges at the first term in which they differ; neighbours too small to be
        nodes of their own stay together."""
        waiting = [(0, len(self.paths), -1)]
        while waiting:
            start, end, parent = waiting.pop()
            node = len(self.spans)
            self.spans.append((start, end))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            if end - start <= self.leaf or self.paths[start] == self.paths[end - 1]:
                continue
            depth = self._shared(start, end)
            cuts = [i for i in range(start + 1, end)
                    if self.paths[i][depth:depth + 4] != self.paths[i - 1][depth:depth + 4]]
            bounds, at = [], start
            for here, after in zip(cuts, [*cuts[1:], end], strict=True):
                # Cut before a run that would make the piece too large, and behind one
                # that is large by itself.
                if after - at > self.leaf and here > at:
                    bounds.append((at, here))
                    at = here
            bounds.append((at, end))
            waiting.extend((a, b, node) for a, b in reversed(bounds))

    def _bound(self) -> None:
        """Largest counts, least factor and least id of every node."""
        nodes = len(self.spans)
        leaves = [i for i in range(nodes) if not self.children[i]]
        starts = np.array([self.spans[i][0] for i in leaves])
        self.most = np.zeros((self.counts.shape[0], nodes), np.int32)
        self.least = np.zeros(nodes, np.int64)
        self.first_id = np.zeros(nodes, np.int64)
        # The leaves' ranges follow each other and cover all documents.
        self.most[:, leaves] = np.maximum.reduceat(self.counts, starts, axis=1)
        self.least[leaves] = np.minimum.reduceat(self.factor, starts)
        self.first_id[leaves] = np.minimum.reduceat(self.ids, starts)
        for node in range(nodes - 1, -1, -1):
            if below := self.children[node]:
                self.most[:, node] = self.most[:, below].max(axis=1)
                self.least[node] = self.least[below].min()
                self.first_id[node] = self.first_id[below].min()

    def search(self, columns: np.ndarray, weights: np.ndarray, best: list[tuple[int, int]],
               top: int = TOP) -> list[tuple[int, int]]:
        """The ``top`` of ``best`` and of this tree as (-score, id), in order."""
        bounds = parts_of_score(self.most[columns].T.astype(np.int64), self.least) @ weights
        hopeful = [0]
        while hopeful:
            node = hopeful.pop()
            bound = (-int(bounds[node]), int(self.first_id[node]))
            if bound[0] == 0 or (len(best) == top and bound >= best[-1]):
                continue
            below = self.children[node]
            if below:
                hopeful.extend(sorted(below, key=bounds.__getitem__))
                continue
            start, end = self.spans[node]
            counts = self.counts[columns, start:end].T.astype(np.int64)
            scores = parts_of_score(counts, self.factor[start:end]) @ weights
            least = -best[-1][0] if len(best) == top else 1
            found = np.flatnonzero(scores >= least)
            best = sorted([*best, *zip((-scores[found]).tolist(),
                                       self.ids[start:end][found].tolist(), strict=True)])[:top]
        return best


@dataclass(frozen=True)
class Collection:
    """What the score needs of all documents: their number, their terms, and the
    documents that hold each query term."""

    documents: int
    terms: int
    holding: dict[int, int]


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """Distinct (item, term); an item's rows are one item."""
    def prepare():
        return lambda texts: [pa.array([sorted(set(plain_words(t))) for t in texts],
                                       pa.list_(pa.binary()))]

    named = items.select(F.col(item).alias("item"), F.col(text).alias("text"))
    field = T.StructField("terms", T.ArrayType(T.BinaryType()))
    rows = text_columns(named, "text", [field], prepare, ["item"])
    return rows.select("item", F.explode("terms").alias("term")).distinct()


def term_vectors(docs: DataFrame, text: str, numbers: dict[bytes, int],
                 keep: Sequence[str]) -> DataFrame:
    """Per document: its number of terms, and the numbers and counts of its query terms."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)
    fields = [T.StructField("n", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
              T.StructField("counts", T.ArrayType(T.IntegerType()))]

    def prepare():
        number = shared.value.get

        def count(texts):
            sizes, ids, counts = [], [], []
            for words in map(plain_words, texts):
                known = np.fromiter((number(w, -1) for w in words), np.int32, len(words))
                own, often = np.unique(known[known >= 0], return_counts=True)
                sizes.append(len(words))
                ids.append(own)
                counts.append(often.astype(np.int32))
            return [pa.array(sizes, pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int32()))]
        return count

    return text_columns(docs, text, fields, prepare, keep)


def collection(vectors: DataFrame) -> Collection:
    """One row of sums, and one row per query term that occurs."""
    row = vectors.agg(F.count_if(F.col("n") > 0).alias("documents"),
                      F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    held = vectors.select(F.explode("ids").alias("id")).groupBy("id").count().collect()
    return Collection(row.documents, row.terms, {r.id: r["count"] for r in held})


#: An absent id comes before all others.
NO_ID = -2**63


def best_of_tasks(vectors: DataFrame, queries: dict[int, list[int]], known: Collection,
                  top: int, cells: int) -> DataFrame:
    """(item, doc_id, score): per task and item the ``top`` documents of the task."""
    # Columns by falling frequency; terms that no document holds have none.
    column = {t: i for i, t in enumerate(
        sorted(known.holding, key=lambda t: (-known.holding[t], t)))}
    searches = []
    for item, terms in queries.items():
        pairs = [(column[t], term_weight(known.documents, known.holding[t]))
                 for t in terms if t in column]
        searches.append((item, np.array([c for c, _ in pairs], np.int64),
                         np.array([w for _, w in pairs], np.int64)))
    place = np.full(max(column, default=0) + 1, -1, np.int64)
    for term, i in column.items():
        place[term] = i
    width, documents, terms = len(column), known.documents, known.terms
    shared = vectors.sparkSession.sparkContext.broadcast((place, searches))
    schema = T.StructType([T.StructField("item", T.IntegerType()),
                           T.StructField("doc_id", T.LongType()),
                           T.StructField("score", T.LongType())])

    def trees(batches) -> Iterator[DocumentTree]:
        place = shared.value[0]
        most = max(1, cells // width)
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                part = batch.slice(start, most)
                ids = part.column(0).fill_null(NO_ID).to_numpy()
                sizes = part.column(1).to_numpy()
                own, counts = part.column(2), part.column(3)
                lengths = np.diff(own.offsets.to_numpy())
                factor = 10 + (90 * sizes * documents) // terms
                yield DocumentTree(
                    ids, factor, np.repeat(np.arange(len(ids)), lengths),
                    place[own.flatten().to_numpy()], counts.flatten().to_numpy(), width)

    def run(batches):
        searches = shared.value[1]
        best = {item: [] for item, _, _ in searches}
        for tree in trees(batches):
            for item, columns, weights in searches:
                if len(columns):
                    best[item] = tree.search(columns, weights, best[item], top)
        rows = [(item, None if i == NO_ID else i, -s) for item, own in best.items() for s, i in own]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], kind) for k, kind in
             enumerate((pa.int32(), pa.int64(), pa.int64()))], names=schema.names)

    held = vectors.where(F.size("ids") > 0).select("doc_id", "n", "ids", "counts")
    return held.mapInArrow(run, schema)


def best_of_items(rows: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each item with their rank; first within parts of an item."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    for keys in (["item", "_salt"], ["item"]):
        salted = salted.withColumn(
            "rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        ).where(F.col("rank") <= top)
    return salted.drop("_salt")


def search_documents(docs: DataFrame, items: DataFrame, *, item: str = "item_id",
                     doc: str = "doc_id", text: str = "text", top: int = TOP,
                     most_pairs: int = MOST_PAIRS, cells: int = CELLS) -> DataFrame:
    """Per item its ``top`` documents: item, rank, doc and score, best first.

    Every document is a candidate of every item. Rows of one item id, null included, are
    one item with the terms of all of them. Null and empty texts have no terms: such
    items have no rows, such documents are counted nowhere. Repeated documents count and
    rank each; equal scores stand by ascending id, a null id first. A very long text is
    one vector, bounded by the number of query terms. Empty tables give no rows. Other
    columns are not read. The queries' terms go to all tasks, in parts of the items
    beyond ``most_pairs``; the driver also gets one count per query term.
    """
    schema = T.StructType([
        T.StructField(item, items.schema[item].dataType), T.StructField("rank", T.IntegerType()),
        T.StructField(doc, T.LongType()), T.StructField("score", T.LongType())])
    narrow = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    pairs = written(item_terms(items, item, text), "query-terms")
    parts = max(1, -(-pairs.count() // most_pairs))
    part_of = F.pmod(F.xxhash64("item"), F.lit(parts))
    found = docs.sparkSession.createDataFrame([], schema)
    for part in range(parts):
        own = pairs.where(part_of == part).collect()
        numbers = {t: i for i, t in enumerate(sorted({bytes(r.term) for r in own}))}
        names = {x: i for i, x in enumerate(dict.fromkeys(r.item for r in own))}
        queries: dict[int, list[int]] = {i: [] for i in names.values()}
        for r in own:
            queries[names[r.item]].append(numbers[bytes(r.term)])
        vectors = written(term_vectors(narrow, "_text", numbers, ["doc_id"]), "term-vectors")
        known = collection(vectors)
        if not known.holding:
            continue
        best = best_of_items(best_of_tasks(vectors, queries, known, top, cells), top)
        labels = docs.sparkSession.createDataFrame(
            [(i, x) for x, i in names.items()], T.StructType([
                T.StructField("item", T.IntegerType()),
                T.StructField("_name", items.schema[item].dataType)]))
        found = found.unionByName(best.join(labels, "item").select(
            F.col("_name").alias(item), "rank", F.col("doc_id").alias(doc), "score"))
    return found
