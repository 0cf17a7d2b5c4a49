"""Texts read once, shuffles let go, windows told by their own anchors."""

from __future__ import annotations

import glob
import re
import time

import numpy as np
import pytest
from conftest import plan_of

from cohortloom.llm import jaccard_join, passages
from cohortloom.llm.common import DROP_SHUFFLES, written
from cohortloom.llm.jaccard_join import JaccardJoin, bit_map
from cohortloom.llm.queries import QUERIES
from cohortloom.llm.spans import word_codes
from cohortloom.llm.tokens import UnitStore
from pyspark.sql import functions as F


def test_the_mixture_counts_words_once(spark, small):
    assert "regexp_count" not in plan_of(QUERIES["op8_systematic_mix"](spark, small))


def shuffle_files(spark):
    home = spark.sparkContext.getConf().get("spark.local.dir", "/tmp")
    return set(glob.glob(f"{home}/blockmgr-*/*/shuffle_*.data"))


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before, was = shuffle_files(spark), spark.conf.get(DROP_SHUFFLES)
    stored = written(spark.range(50_000).groupBy((F.col("id") % 7919).alias("k")).count(), "groups")
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(DROP_SHUFFLES) == was and stored.count() == 7919


def test_only_windows_of_a_repeated_least_anchor_are_taken(spark):
    words = [f"w{i}" for i in np.random.default_rng(3).integers(0, 10_000, 60)]
    codes, = word_codes([" ".join(words).encode()])
    anchors, _ = passages.anchors_of(codes)
    taken = [passages.windows_at(codes, [a])[0].tolist() for a in anchors.tolist()]
    # Every window belongs to one anchor, so a repeated one takes its own windows only.
    assert sorted(sum(taken, [])) == list(range(60 - passages.WINDOW + 1))
    lines = [(1, " ".join(words)), (2, "x " + " ".join(words[5:45]) + " y"), (3, "a b c"), (4, None)]
    got = {r.doc_id: r for r in passages.remove_repeats(
        spark.createDataFrame(lines, "doc_id long, text string")).collect()}
    assert got[2].kept_text.split() == ["x", "y"] and got[2].removed_words == 40
    assert got[1].removed_words == 0 and got[4].kept_text is None


def test_windows_of_equal_blocks_are_no_rows_of_their_own(spark, monkeypatch):
    words = [f"w{i}" for i in np.random.default_rng(5).integers(0, 10_000, 200)]
    docs = spark.createDataFrame([(i, " ".join(words)) for i in range(4)], "doc_id long, text string")
    counts, plain = [], passages.repeats_of
    monkeypatch.setattr(passages, "repeats_of", lambda places: (
        counts.append(places.count()), plain(places))[1])
    got = {r.doc_id: r.removed_words for r in passages.remove_repeats(docs).collect()}
    # The units, one in each text, and no window: every anchor has one block only.
    assert counts == [4, 0] and got == {0: 0, 1: 200, 2: 200, 3: 200}


def by_brute_force(rows):
    """removed spans of (id, text) rows whose ids are in order, by all windows of all texts."""
    units, windows, out = {}, {}, {}
    for ident, text in rows:
        codes = text.split()
        for place, unit in enumerate(passages.units_of(text.encode())):
            units.setdefault(unit[3], (ident, place))
        for place in range(len(codes) - passages.WINDOW + 1):
            windows.setdefault(tuple(codes[place:place + passages.WINDOW]), (ident, place))
    for ident, text in rows:
        codes, pairs = text.split(), []
        own = [place for place, unit in enumerate(passages.units_of(text.encode()))
               if units[unit[3]] != (ident, place)]
        for place in range(len(codes) - passages.WINDOW + 1):
            row, first = windows[tuple(codes[place:place + passages.WINDOW])]
            if (row, first) != (ident, place):
                pairs += [max(place, first + passages.WINDOW) if row == ident else place,
                          place + passages.WINDOW]
        out[ident] = passages.runs(text.encode(), own, pairs)
    return out


def test_blocks_give_what_all_windows_give(spark):
    random = np.random.default_rng(8)
    passage = [[f"p{k}x{i}" for i in random.integers(0, 400, 90)] for k in range(5)]
    rows = []
    for ident in range(60):
        words = []
        for _ in range(random.integers(1, 5)):
            own = passage[random.integers(5)]
            start = int(random.integers(0, 60))
            words += own[start:start + int(random.integers(10, 90))]
            words += [f"o{i}" for i in random.integers(0, 3, random.integers(0, 40))]
        rows.append((ident, " ".join(words)))
    rows += [(60, rows[7][1]), (61, rows[7][1]), (62, ("a b c " * 40).strip()), (63, ("a " * 70).strip())]
    got = {r.doc_id: [list(s) for s in r.spans] for r in passages.find_repeats(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == by_brute_force(rows) and sum(map(bool, got.values())) > 40


def test_long_sets_that_are_not_similar_do_not_meet(spark):
    rule = JaccardJoin()
    words = [f"w{i}" for i in range(9000)]
    texts = [words[:6000], words[1500:7500], words[20:6020], [*words[:5000], *words[8000:]]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)],
                                 "ident long, _text string").withColumn("text_hash", F.xxhash64("_text"))
    nodes = docs.select(F.col("ident").alias("node"), "ident", "text_hash")
    pairs = spark.createDataFrame([(a, b) for a in range(4) for b in range(a + 1, 4)], "a long, b long")
    sets = [jaccard_join.shingles(c, rule.size) for c in word_codes([" ".join(t).encode() for t in texts])]
    # The maps of the index are full of ones and rule none of these pairs out.
    few = [np.frombuffer(bit_map(s, rule.map_words), np.uint64) for s in sets]
    apart = np.array([np.bitwise_count(few[0] ^ few[1]).sum(dtype=np.int64)])
    assert jaccard_join.may_be_similar(np.array([len(sets[0])]), np.array([len(sets[1])]), apart, rule)[0]
    near = jaccard_join.near_candidates(pairs, docs, nodes, rule)
    assert [tuple(r) for r in near.collect()] == [(0, 2)]
    assert [tuple(r) for r in jaccard_join.similar(pairs, docs, nodes, rule).collect()] == [(0, 2)]


def test_folded_maps_never_differ_in_more_bits_than_the_sets():
    rule, random = JaccardJoin(), np.random.default_rng(2)
    assert rule.words_for(0) == rule.words_for(256) == 32 and rule.words_for(257) == 64
    for n, m in ((230, 260), (500, 520), (1000, 1100), (3, 5000)):
        tokens = random.integers(0, 2**63, n + m, np.uint64)
        one, two = np.unique(tokens[:n]), np.unique(tokens[n // 2:n // 2 + m])
        maps = [bit_map(s, rule.words_for(len(s))) for s in (one, two)]
        found = jaccard_join.differing(*maps)
        assert found == jaccard_join.differing(*maps[::-1]) <= len(np.setxor1d(one, two))
        assert jaccard_join.differing(maps[0], maps[0]) == 0


@pytest.mark.parametrize("rule", [JaccardJoin(), JaccardJoin(block=32, nearest=(1,))])
def test_near_copies_far_from_the_centres_are_not_paired_all(spark, monkeypatch, rule):
    # Two of 24 words are changed: texts with a changed place in common are similar, others are not.
    base = [f"w{i}" for i in range(160)]
    texts = [" ".join(f"{w}x{i}y{j}" if k in (6 * i + 2, 6 * j + 2) else w for k, w in enumerate(base))
             for i in range(24) for j in range(i)]
    apart = [" ".join(base[:100] + [f"{s}{k}" for k in range(60)]) for s in "ab"]
    stored, plain = [], jaccard_join.written

    def counted(df, name):
        out = plain(df, name)
        if name == "jaccard-pairs":
            stored.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "written", counted)
    docs = spark.createDataFrame(list(enumerate(texts + apart)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.link_documents(docs, rule).collect()}
    assert got == dict.fromkeys(range(276), 0) | {276: 276, 277: 277}
    # All similar pairs are 276 * 44 / 2 = 6,072; without nearest ones first, 3,752 were formed.
    assert rule.block < 512 or sum(stored) < 2500


def test_whole_rows_are_shuffled_once_to_keep_one_each(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, "x y z u v"),
            (3, "x y z u v"), (3, "x y z u v"), (None, "q r s t u"), (None, "q r s t u"), (5, " "), (5, " ")]
    kept = jaccard_join.keep_one_each(spark.createDataFrame(rows, "doc_id long, text string"),
                                      by="component")
    plan = kept._sc._jvm.PythonSQLUtils.explainString(kept._jdf.queryExecution(), "formatted")
    moved = re.findall(r"\(\d+\) Exchange\n(?:Input|Output) *\[\d+\]: \[([^\n]*)\]", plan)
    assert moved and sum("_row#" in m for m in moved) == 1
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in kept.collect() if r.doc_id) == [
        (False, 1, "a b c d e f"), (False, 3, "x y z u v"), (False, 5, " "), (False, 5, " ")]
    assert [r.text for r in kept.collect() if r.doc_id is None] == ["q r s t u"]


def test_a_unit_is_looked_up_once():
    class Counted(dict):
        looked = 0

        def __contains__(self, key):
            self.looked += 1
            return super().__contains__(key)

        def __getitem__(self, key):
            self.looked += 1
            return super().__getitem__(key)

        def get(self, key, default=None):
            self.looked += 1
            return super().get(key, default)

    store = UnitStore("H")
    store.known = Counted()
    codes, units = np.arange(10, 60, dtype=np.uint64), [b"x" * (i % 3 + 1) for i in range(50)]

    def encode(new):
        sizes = np.array(list(map(len, new)), np.int64)
        return np.repeat(np.arange(len(new), dtype=np.uint16), sizes), np.cumsum(sizes) - sizes, sizes

    first = store.slots(codes, lambda new: [units[i] for i in new], encode)
    again = store.slots(codes[::-1], lambda new: [units[::-1][i] for i in new], encode)
    assert first.tolist() == again[::-1].tolist() == list(range(50)) and store.known.looked == 100
    assert store.sizes()[first].tolist() == list(map(len, units))
