from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from dataclasses import replace

import numpy as np
import public_tokenizers
import pytest
import zstandard
from llm_helpers import frame, odd_rows, package_on_workers, prose  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortloom.llm.components import connected
from cohortloom.llm.decontaminate import (clean_documents, find_leaks, leak_report,
                                          without_words)
from cohortloom.llm.jaccard_join import (JaccardJoin, WordHashes, index_keys, keep_one_each,
                                         link_documents)
from cohortloom.llm.license_rules import LicenseScanner, all_rules, resolve, scan_licenses
from cohortloom.llm.passages import remove_repeats
from cohortloom.llm.token_counts import count_tokens
from cohortloom.llm.token_store import read_documents, read_index, train_dictionary, write_store
from cohortloom.llm.tokens import Encoder
from cohortloom.llm.window_lm import WindowModel, fit, log_likelihoods, score_documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BPE = public_tokenizers.path("byte_bpe_50k.json")


def plain(text):
    return PLAIN.findall((text or "").translate(LOWER))


# -- decontamination ------------------------------------------------------------

def brute_leaks(docs, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        words = plain(text)
        n = min(size, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i:i + n])].add("" if item is None else str(item))
    out = Counter()
    for doc_id, text in docs:
        words, hit, found = plain(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                own = windows.get(tuple(words[i:i + n]), ())
                if own:
                    hit |= set(range(i, i + n))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc_id, len(words), len(hit), len(found), digest, bool(hit)] += 1
    return out


@pytest.mark.parametrize("most_windows", [500_000, 15])
def test_leaks_equal_brute_force(spark, odd_rows, most_windows):
    items = [(1, prose(50, 30)), (2, "Short ONE"), (None, prose(51, 12)), (4, None), (5, "..."),
             (6, prose(50, 14)), (10, "Äpfel-und Birnen 中文")]
    docs = odd_rows + [(30, "x " + prose(50, 30).replace(" ", ", ").upper() + " y", "a"),
                       (31, prose(50, 9), "a"), (32, "a short one b SHORT-one", "a"),
                       (33, prose(50, 22) + " " + prose(51, 12), "a"), (34, "äpfel und birnen 中文", "b")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = find_leaks(frame(spark, docs, clashing=True), benchmark, most_windows=most_windows)
    got = Counter(tuple(r) for r in leak_report(found).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect())
    assert got == brute_leaks([(i, t) for i, t, _ in docs], items)


def test_documents_or_spans_are_removed(spark, odd_rows):
    leak = prose(60, 15)
    docs = odd_rows + [(40, f"Before it. {leak}! After it.", "a")]
    benchmark = spark.createDataFrame([(1, leak)], "item_id long, text string")
    given = frame(spark, docs, clashing=True)
    kept = clean_documents(given, benchmark)
    assert kept.columns == given.columns
    assert Counter(map(tuple, kept.collect())) == Counter(
        tuple(r) for r in given.collect() if r.doc_id != 40)
    cut = clean_documents(given, benchmark, remove="spans").where("doc_id = 40").first()
    assert cut.text == "Before it. ! After it."
    assert without_words("ä b c".encode(), [[0, 1], [2, 3]]) == b" b "
    none = benchmark.where("false")
    assert clean_documents(given, none).count() == len(docs)
    assert clean_documents(given.where("false"), benchmark).count() == 0


# -- near copies ------------------------------------------------------------------

def shingle_set(text):
    words = (text or "").translate(LOWER).encode().split()
    return frozenset(tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()


def brute_components(rows, percent=85):
    sets = [shingle_set(t) for _, t, _ in rows]
    part = list(range(len(rows)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                part[root(i)] = root(j)
    least = {}
    for i, (doc_id, _, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return Counter((r[0], len(sets[i]), least.get(root(i)) if sets[i] else r[0])
                   for i, r in enumerate(rows))


def family(seed, n, words=80, edits=4):
    """Copies of one text, each with some words changed: similar to some others only."""
    rng = random.Random(seed)
    base = prose(seed, words).split()
    out = []
    for k in range(n):
        own = list(base)
        for _ in range(rng.randrange(edits)):
            own[rng.randrange(words)] = f"e{seed}_{k}_{rng.randrange(9)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("rule", [
    JaccardJoin(), JaccardJoin(frequent=0.0, block=8, sketch_bits=10, most_broadcast=0)])
def test_components_equal_brute_force(spark, odd_rows, rule):
    texts = [t for s in range(6) for t in family(s, 40)] + family(90, 60, 120, 9)
    texts += ["one two three"] * 3 + ["ONE two three", "one two", "a b c d e f g h i", "a b c d e f g h i j"]
    rows = odd_rows + [(1000 + 7 * i % 997, t, "s") for i, t in enumerate(texts)]
    got = link_documents(frame(spark, rows, clashing=True), rule).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows)


def test_similar_sets_share_a_key():
    rng = np.random.default_rng(5)
    rule = JaccardJoin()
    for trial in range(300):
        n = int(rng.integers(6, 400))
        tokens = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        other = np.unique(np.concatenate([tokens[rng.random(len(tokens)) < 0.93], rng.integers(
            0, 1 << 63, int(0.06 * n), dtype=np.uint64)]))
        both = len(np.intersect1d(tokens, other))
        if 100 * both < 85 * (len(tokens) + len(other) - both):
            continue
        limit = [-1, 50, 1000][trial % 3]
        keys = [index_keys(t, (t % np.uint64(100)).astype(np.int64), limit, rule)
                for t in (tokens, other)]
        assert len(np.intersect1d(*keys)), (len(tokens), len(other), both)


def test_one_row_of_each_component_stays(spark, odd_rows):
    rows = odd_rows + [(200 + i, t, "s") for i, t in enumerate(family(3, 30))]
    docs = frame(spark, rows, clashing=True)
    linked = link_documents(docs).where("n_shingles > 0")
    kept = keep_one_each(docs)
    assert kept.columns == docs.columns
    with_words = [r for r in kept.collect() if shingle_set(r.text)]
    assert len(with_words) == linked.select("component_id").distinct().count()
    assert {r.doc_id for r in with_words} == {r.component_id for r in linked.collect()}
    blank = [r for r in rows if not shingle_set(r[1])]
    assert kept.count() == len(with_words) + len(blank)
    assert keep_one_each(docs.where("false")).count() == 0


def test_unlinked_rows_with_null_or_equal_ids_all_stay(spark):
    rows = [(None, prose(31, 30), "s"), (None, prose(32, 30), "s"), (8, prose(33, 30), "s"),
            (8, prose(34, 30), "s"), (9, prose(34, 30), "s"), (None, prose(34, 30), "s"),
            (None, prose(32, 30), "s")]
    kept = keep_one_each(frame(spark, rows, clashing=True), by="component").collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter((i, t) for i, t, _ in rows[:4])


def test_components_of_chains_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (9, 9)]
    edges += [(200, 200 + i) for i in range(1, 60)]
    got = {r.node: r.component for r in connected(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100,
                   **{200 + i: 200 for i in range(60)}}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


# -- tokens -------------------------------------------------------------------------

HARD = ["", " ", "a  b", " a", "a ", "\n\n x\n", "it's we'll I'M 's", "a\t\tb \n c", "x\x1cy \x85z",
        "<|endoftext|>", "a <|endoftext|>", "a  <|endoftext|>  b<|endoftext|>c", "中文 字　字  x",
        "1234 5a6 ½ Ⅷ ²", "\U0001f600 \U0001f600\U0001f600", "é é", "-- ... ?!x y_z", "\xa0x \xa0 y",
        "​ ﻿a", "A" * 300, "don't stop \r\n now"]


def test_units_give_the_ids_of_the_library():
    own, library = Encoder(BPE), Tokenizer.from_file(BPE)
    assert own.by_unit
    rng = random.Random(0)
    texts = HARD + ["".join(rng.choice([chr(rng.randrange(1, 0x3000)), " ", "\n", "a", "'s"])
                            for _ in range(60)) for _ in range(300)]
    for text, ids in zip(texts, own.ids(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_other_vocabularies_are_encoded_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = Encoder(path), Tokenizer.from_file(path)
    assert not own.by_unit
    for text, ids in zip(HARD, own.ids(HARD), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("most_common", [500_000, 5])
def test_token_counts_equal_the_library(spark, odd_rows, most_common):
    rows = odd_rows + [(50 + i, t, "s") for i, t in enumerate(HARD)]
    got = count_tokens(frame(spark, rows, clashing=True), BPE, most_common=most_common).collect()
    library = Tokenizer.from_file(BPE)
    want = Counter()
    for i, t, _ in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want[i, len((t or "").encode()), n, n > 512] += 1
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert count_tokens(frame(spark, []), BPE).count() == 0


def test_store_round_trip(spark, odd_rows, tmp_path):
    rows = odd_rows + [(50 + i, t, "s") for i, t in enumerate(HARD)] + [
        (100 + i, prose(i, 20 + i % 50), "s") for i in range(300)]
    docs = frame(spark, rows, clashing=True)
    write_store(docs, f"{tmp_path}/s", BPE)
    library = Tokenizer.from_file(BPE)
    ids = defaultdict(list)
    for i, t, _ in rows:
        ids[i].append(library.encode(t or "", add_special_tokens=False).ids + [0])
    got = sorted(read_index(spark, f"{tmp_path}/s").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _, _ in rows), key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        assert r.start == at
        own = [x for x in ids[r.doc_id] if len(x) == r.n_tokens
               and zlib.crc32(np.array(x, "<u4").tobytes()) == r.ids_crc32]
        assert own
        at += r.n_tokens
    some = read_documents(spark, f"{tmp_path}/s", 60, 70).collect()
    assert {r.doc_id: r.ids for r in some} == {i: ids[i][0] for i in ids if i and 60 <= i <= 70}
    blocks = spark.read.parquet(f"{tmp_path}/s/blocks").collect()
    stored = spark.read.parquet(f"{tmp_path}/s/dictionary").first()
    assert {b.dictionary for b in blocks} == {hashlib.sha256(bytes(stored.dictionary)).hexdigest()}
    assert all(len(b.offsets) == len(b.idents) + 1 and b.offsets[-1] == len(b.frames) for b in blocks)


def test_dictionary_makes_short_documents_smaller(spark):
    docs = frame(spark, [(i, prose(i, 40), "s") for i in range(1500)])
    trained = train_dictionary(docs, BPE)
    assert trained == train_dictionary(docs.repartition(5), BPE)
    own = next(Encoder(BPE).ids([prose(9999, 40)])).tobytes()
    held = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(trained))
    assert len(held.compress(own)) < 0.8 * len(zstandard.ZstdCompressor().compress(own))


def test_empty_store(spark, tmp_path):
    write_store(frame(spark, []), f"{tmp_path}/s", BPE)
    assert read_index(spark, f"{tmp_path}/s").count() == 0


# -- passages -------------------------------------------------------------------------

def sentences(seed, n):
    return " ".join(prose(seed * 100 + k, 9, 5000).capitalize() + "." for k in range(n))


def test_passages_go_and_short_shared_lines_stay(spark, odd_rows):
    passage, line = sentences(1, 7), "All rights reserved."
    rows = [(i, f"{sentences(10 + i, 3)} {passage} {sentences(50 + i, 2)}\n{line}", "s") for i in range(6)]
    rows += [(20, sentences(90, 4), "s"), (21, None, "s"), (22, "", None)]
    got = {r.doc_id: r for r in remove_repeats(frame(spark, rows, clashing=True)).collect()}
    for i, text, _ in rows[:6]:
        raw = text.encode()
        if i == 0:
            assert got[0].kept_text == text and got[0].spans == []
            continue
        (start, end, words), = got[i].spans
        assert raw[start:end].decode() == passage and words == 63 == got[i].removed_words
        assert got[i].kept_text == text.replace(passage, "") and line in got[i].kept_text
    assert got[20].kept_text == rows[6][1] and got[21].kept_text is None and got[22].kept_text == ""


def test_repeated_rows_keep_one_text(spark, odd_rows):
    docs = frame(spark, odd_rows, clashing=True)
    got = remove_repeats(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in odd_rows)
    same = [r for r in got if r.doc_id in (6, 7)]
    assert sorted(r.kept_text == "" for r in same) == [False, True, True]
    assert remove_repeats(docs.where("false")).count() == 0


def test_passages_go_inside_sentences_and_single_lines_go(spark):
    words = sentences(2, 7).split()[3:58]
    passage, line = " ".join(words), prose(3, 19, 5000)
    rows = [(i, f"{prose(300 + i, 30, 5000)} {passage} {prose(400 + i, 25, 5000)}\n"
                f"{prose(500 + i, 8, 5000)}\n{line}\n{prose(600 + i, 8, 5000)}", "s")
            for i in range(4)]
    rows += [(10, "go on " * 60, "s"), (11, None, "s")]
    got = {r.doc_id: r for r in remove_repeats(frame(spark, rows)).collect()}
    assert got[0].kept_text == rows[0][1] and got[11].kept_text is None
    for i, text, _ in rows[1:4]:
        raw = text.encode()
        assert [raw[a:b].decode() for a, b, _ in got[i].spans] == [passage, line]
        assert got[i].removed_words == 55 + 19
        assert got[i].kept_text == text.replace(passage, "").replace(line, "")
    # A window that overlaps its own first occurrence leaves that one whole.
    assert got[10].kept_text.split()[:20] == ["go", "on"] * 10


# -- licenses ---------------------------------------------------------------------------

def test_keywords_stand_in_every_match_and_rules_are_many():
    rules = all_rules()
    assert len(rules) > 300
    assert [r.priority for r in rules] == sorted((r.priority for r in rules), reverse=True)
    for rule in rules:
        re.compile(rule.pattern)


def spelled(tree):
    """Every choice of a parsed pattern, with one or no turn of what repeats."""
    out = [""]
    for kind, value in tree:
        name = str(kind)
        if name == "LITERAL":
            own = [chr(value)]
        elif name == "NOT_LITERAL":
            own = ["x"]
        elif name == "IN":
            own = ["x" if str(value[0][0]) == "NEGATE" else chr(
                value[0][1][0] if str(value[0][0]) == "RANGE" else value[0][1])]
        elif name == "BRANCH":
            own = [s for branch in value[1] for s in spelled(branch)]
        elif name == "SUBPATTERN":
            own = spelled(value[3])
        elif name == "MAX_REPEAT":
            low, high, inner = value
            own = [s * n for s in spelled(inner) for n in {low, min(low + 1, high)}]
        else:
            assert name == "ASSERT_NOT", name
            own = [""]
        out = [a + b for a in out for b in dict.fromkeys(own)]
    return out


def test_every_alternative_of_a_rule_holds_its_keyword():
    ungated = LicenseScanner([replace(r, keyword="") for r in all_rules()])
    gated = LicenseScanner()
    for rule in all_rules():
        own = spelled(re._parser.parse(rule.pattern))
        assert [s for s in own if rule.keyword not in s] == [], rule
        whole = f" {own[-1]} ".encode()
        assert sorted(gated.detections(whole)) == sorted(ungated.detections(whole))
    for text, label in (("without the prior written permission of the publisher", "no-reproduction"),
                        ("tcl tk license", "tcl"), ("psf license", "python")):
        assert label in {d[2] for d in gated.detections(f" {text} ".encode())}


@pytest.mark.parametrize(("text", "labels"), [
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
    ("GNU General Public License, version 3", "gpl,gpl-3.0"),
    ("GNU General Public License v2 or later", "gpl,gpl-2.0-or-later"),
    ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
    ("Released under the MIT License.", "mit"), ("BSD-3-Clause", "bsd-3-clause"),
    ("Mozilla Public License 2.0", "mpl-2.0"), ("nothing here", ""), ("all rights", ""),
    ("SPDX-License-Identifier: LGPL-2.1", "lgpl-2.1,spdx"),
    ("Creative Commons Attribution-ShareAlike 4.0", "cc-by-sa-4.0")])
def test_signatures(spark, text, labels):
    scanner = LicenseScanner()
    whole = b" " + " ".join(plain(text)).encode() + b" "
    base = {b for _, b in scanner.base_places(whole)}
    found = {d[2] for d in resolve(scanner.detections(whole))}
    assert ",".join(sorted(base | found)) == labels


def test_containment_and_priority():
    found = [(0, 9, "a", 2), (2, 4, "b", 2), (3, 12, "c", 1), (1, 5, "d", 3), (2, 4, "e", 1), (20, 21, "f", 1)]
    assert resolve(found) == [(0, 9, "a", 2), (1, 5, "d", 3), (3, 12, "c", 1), (20, 21, "f", 1)]


def test_base_phrases_equal_brute_force(spark, odd_rows):
    phrases = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl",
               ("all", "rights", "reserved"): "reserved"}
    rng = random.Random(3)
    parts = ["cc by", "CC-BY", "cc", "by", "General Public, License", "all rights", "All\nRights reserved",
             "recc by", "cc byte", "äcc by", "x"]
    rows = odd_rows + [(60 + i, " ".join(rng.choices(parts, k=12)), "s") for i in range(60)]
    got = scan_licenses(frame(spark, rows, clashing=True)).collect()
    want = Counter()
    for i, t, _ in rows:
        words = plain(t)
        hits = [(k, label) for p, label in phrases.items() for k in range(len(words))
                if tuple(words[k:k + len(p)]) == p]
        at = [k for k, _ in hits]
        want[i, len(words), len(hits), min(at, default=None), max(at, default=None),
             ",".join(sorted({x for _, x in hits}))] += 1
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                   for r in got) == want
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert scan_licenses(frame(spark, [])).count() == 0


# -- language model -----------------------------------------------------------------------

def chain(seed, n):
    """Words where each says which may come next."""
    rng = random.Random(seed)
    out, at = [], rng.randrange(40)
    for _ in range(n):
        out.append(f"c{at}")
        at = (at * 7 + rng.randrange(2)) % 40
    return out


def test_network_learns_order_and_scores_whole_texts(spark):
    train = frame(spark, [(i, " ".join(chain(i, 200)), "s") for i in range(300)]).repartition(2)
    model = WindowModel(buckets=1 << 10, codes=128, classes=64, masked=0.5)
    vocabulary, weights = fit(train, model)
    held = [chain(1000 + i, 200) for i in range(20)]
    mixed = [random.Random(i).sample(w, len(w)) for i, w in enumerate(held)]
    plain_counts = [w * 0 for w in weights[:2]] + [vocabulary.bias]

    def mean(texts, own=weights):
        n, s = log_likelihoods([" ".join(t).encode() for t in texts], WordHashes(), vocabulary, own, model)
        return s.sum() / n.sum()

    assert mean(held) > mean(held, plain_counts) + 0.5
    assert mean(held) > mean(mixed) + 0.5
    whole = mean([held[0]]) * 200
    parts = log_likelihoods([" ".join(held[0]).encode(), None, b""], WordHashes(), vocabulary, weights, model)
    assert parts[0].tolist() == [200, 0, 0] and parts[1][0] == pytest.approx(whole, rel=1e-5)


def test_odd_documents_are_scored(spark, odd_rows):
    model = WindowModel(buckets=256, codes=64, classes=32, width=4, rounds=1)
    got = score_documents(frame(spark, odd_rows, clashing=True), model).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter(
        (i, len((t or "").encode().split())) for i, t, _ in odd_rows)
    for r in got:
        assert (r.mean_log_likelihood is None) == (r.n_tokens == 0)
        assert r.log_likelihood < 0 if r.n_tokens else r.log_likelihood == 0
    assert score_documents(frame(spark, []), model).count() == 0
