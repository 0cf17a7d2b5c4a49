from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortloom.llm.lexical_search import DocumentTree, search_documents
from llm_helpers import frame, odd_rows, package_on_workers, prose  # noqa: F401

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def by_hand(docs, items, top=10):
    """(item, rank, id, score) of the definition, document by document."""
    counted = [(i, Counter(terms_of(t))) for i, t, _ in docs]
    counted = [(i, c, c.total()) for i, c in counted if c]
    number, total = len(counted), sum(n for _, _, n in counted)
    holding = Counter(t for _, c, _ in counted for t in c)
    weight = {t: math.floor(1000 * math.log((2 * number + 2) / (2 * df + 1)))
              for t, df in holding.items()}
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item].update(terms_of(text))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, c, n in counted:
            m = 10 + (90 * n * number) // total
            scored.append((sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                               for t in terms if c[t]), i))
        best = sorted((x for x in scored if x[0] > 0),
                      key=lambda x: (-x[0], x[1] is not None, x[1] or 0))[:top]
        out += [(item, k, i, s) for k, (s, i) in enumerate(best, 1)]
    return Counter(out)


def found(spark, docs, items, **options):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = search_documents(frame(spark, docs, clashing=True), benchmark, **options).collect()
    return Counter((r.item_id, r.rank, r.doc_id, r.score) for r in rows)


ITEMS = [(1, prose(50, 12)), (2, "w1 W1 w2, ÄÖ w3"), (None, "w7 w8"), (3, None), (4, ""),
         (5, "absent words only"), (2, "w9"), (6, prose(51, 400)), (7, "中文 über")]


def test_equals_brute_force_on_odd_rows(spark, odd_rows):
    docs = odd_rows + [(100 + i, prose(100 + i, 5 + i % 70), "z") for i in range(150)]
    docs += [(400 + i, prose(3, 25), "z") for i in range(60)]  # copies: ties by id
    assert found(spark, docs, ITEMS) == by_hand(docs, ITEMS)


@pytest.mark.parametrize("options", [{"most_pairs": 40}, {"cells": 6000}, {"top": 3}])
def test_parts_small_trees_and_other_tops_change_nothing(spark, odd_rows, options):
    docs = odd_rows + [(100 + i, prose(200 + i % 90, 30), "z") for i in range(200)]
    assert found(spark, docs, ITEMS, **options) == by_hand(docs, ITEMS, options.get("top", 10))


def test_empty_tables(spark):
    assert found(spark, [], ITEMS) == Counter()
    assert found(spark, [(1, "w1", "a")], []) == Counter()
    assert found(spark, [(1, None, "a"), (2, "...", "a")], ITEMS) == Counter()


def test_tree_bounds_hold_and_subtrees_are_left_out():
    rng = np.random.default_rng(5)
    documents, width = 3000, 60
    counts = rng.poisson(np.linspace(2, 0.02, width), (documents, width))
    counts[counts.sum(axis=1) == 0, 0] = 1
    rows, columns = np.nonzero(counts)
    factor = rng.integers(20, 400, documents)
    tree = DocumentTree(np.arange(documents), factor, rows, columns, counts[rows, columns], width)
    for node, (start, end) in enumerate(tree.spans):
        below = tree.children[node]
        if below:
            assert [tree.spans[k] for k in below][0][0] == start
            assert [tree.spans[k] for k in below][-1][1] == end
        assert (tree.most[:, node] == tree.counts[:, start:end].max(axis=1)).all()
        assert tree.least[node] == tree.factor[start:end].min()
    assert sorted(tree.order.tolist()) == list(range(documents))

    visited = []
    tree.spans = [tuple(s) for s in tree.spans]

    class Seen(list):
        def __getitem__(self, k):
            visited.append(k)
            return super().__getitem__(k)

    leaves = sum(not c for c in tree.children)
    tree.spans = Seen(tree.spans)
    columns, weights = np.array([40, 55, 58]), np.array([3000, 5000, 6000])
    best = tree.search(columns, weights, [])
    scores = ((10**9 * counts[:, columns]) // (1000 * counts[:, columns] + 8 * factor[:, None])) @ weights
    assert best == sorted((-int(s), i) for i, s in enumerate(scores) if s)[:10]
    assert len(visited) < leaves
