from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pytest
from llm_helpers import frame, odd_rows, package_on_workers, prose  # noqa: F401
from test_search_and_tokens import brute_components, family, plain, shingle_set
from test_rules_and_mixing import counts_of, filled

import corpus_pipeline
from cohortloom.llm.queries import QUERIES

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, odd_rows, tmp_path_factory):
    """Documents of all kinds and a benchmark, stored as the given tables are."""
    path = tmp_path_factory.mktemp("corpus")
    leak = prose(700, 16)
    rows = odd_rows + [(100 + i, t, f"s{i % 4}") for i, t in enumerate(family(5, 25))]
    rows += [(200 + i, prose(i, 40 + i % 60), f"s{i % 6}") for i in range(150)]
    rows += [(400 + i, f"{prose(800 + i, 20)} {leak} {prose(900 + i, 9)}", "s1") for i in range(5)]
    rows += [(500 + i, "a b c d e " * 30, "s2") for i in range(3)]
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, leak), (2, None)], "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet")
    return str(path), rows, leak


def ids(rows):
    return Counter(r.doc_id for r in rows)


def test_each_stage_against_brute_force(spark, folder):
    path, rows, leak = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns

    docs = STAGES["quality_rules"](spark, docs, path).checkpoint()
    good = [r for r in rows if (n := counts_of(r[1]))[0] >= 10 and 100 * n[4] <= 20 * n[0]]
    assert docs.columns == columns and ids(docs.collect()) == Counter(i for i, _, _ in good)

    docs = STAGES["near_copies"](spark, docs, path).checkpoint()
    least = {(c, n) for i, n, c in brute_components(good) if n}
    assert docs.columns == columns
    assert set(ids(docs.collect())) == {c for c, _ in least}
    kept = [(r.doc_id, r.text, r.source) for r in docs.collect()]

    docs = STAGES["decontamination"](spark, docs, path).checkpoint()
    words = plain(leak)
    windows = {tuple(words[i:i + 10]) for i in range(len(words) - 9)}
    clean = [r for r in kept if not any(tuple(w[i:i + 10]) in windows for w in [plain(r[1])]
                                        for i in range(len(w) - 9))]
    assert docs.columns == columns and ids(docs.collect()) == Counter(i for i, _, _ in clean)
    assert len(clean) == len(kept) - 5

    mixed = STAGES["mixing"](spark, docs, path).checkpoint()
    assert mixed.columns == columns
    size = defaultdict(int)
    for _, t, s in clean:
        size[s] += len((t or "").split())
    names = sorted(size, key=lambda s: (s is None, s or ""))
    target = dict(zip(names, filled([size[s] for s in names]), strict=True))
    taken, most = defaultdict(int), max(len((t or "").split()) for _, t, _ in clean)
    for r in mixed.collect():
        taken[r.source] += len((r.text or "").split())
    assert all(abs(taken[s] - target[s]) <= most for s in names)
    assert all(n <= 3 for n in ids(mixed.collect()).values())

    placed = STAGES["sharding"](spark, mixed, path)
    assert placed.columns == [*columns, "shard", "slot"]
    out = placed.collect()
    assert ids(out) == ids(mixed.collect())
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_run_equals_its_stages_and_repeats(spark, folder):
    path, _, _ = folder
    first, again = (corpus_pipeline.run(spark, path).collect() for _ in range(2))
    assert sorted(map(repr, first)) == sorted(map(repr, again)) and first


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_take_odd_and_empty_tables(spark, folder, odd_rows, name):
    path, _, _ = folder
    odd = frame(spark, odd_rows, clashing=True)
    out = STAGES[name](spark, odd, path)
    last = name == corpus_pipeline.STAGES[-1][0]
    assert out.columns == [*odd.columns, *(["shard", "slot"] if last else [])]
    assert len(out.collect()) <= 3 * len(odd_rows)
    assert STAGES[name](spark, frame(spark, []), path).count() == 0


def test_thirteen_operators_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert math.isclose(len(corpus_pipeline.STAGES), 5) and shingle_set(None) == frozenset()
