from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from cohortloom.llm.dialogue_repair import (EMPTY, SuffixAutomaton, conversation_report, damage,
                                            followed, node_table, repair_conversations)
from cohortloom.llm.oracles import DIALOGUE_REPAIR
from llm_helpers import package_on_workers  # noqa: F401
from pyspark.sql import functions as F

FORM = re.compile(r"(s?(ua)+)?")


def cheapest(symbols):
    """(cost, audit) over every sequence of edits with up to two insertions in a gap."""
    options = []
    for x in symbols:
        broken = 5 * x.isupper()
        keep = [] if x == "d" else [("K", broken, x.lower()), ("R", 1 + broken, "u"), ("R", 1 + broken, "a")]
        options += [[("", 0, ""), ("I", 5, "u"), ("I", 5, "a"), ("II", 10, "ua"), ("II", 10, "au")],
                    [("D", 2, ""), *keep]]
    options.append(options[0] if options else [("", 0, "")])
    best = None
    for way in itertools.product(*options):
        if FORM.fullmatch("".join(w[2] for w in way)):
            found = (sum(w[1] for w in way), "".join(w[0] for w in way))
            best = found if best is None or found < best else best
    return best


def of_table(table, word):
    missing = {0: 0, 1: 2, 2: 1, 3: 0}
    return min((c + 5 * missing[e], a + "I" * missing[e]) for e, (c, a) in table[0].items())


def test_tables_equal_all_sequences_of_edits():
    words = [w for n in range(4) for w in itertools.product("suaoSAd", repeat=n)]
    automaton = SuffixAutomaton()
    for word in sorted(("".join(w) for w in words), key=lambda w: w[::-1]):
        assert of_table(automaton.table(word), word) == cheapest(word), word
    # One node per distinct suffix, however many words share it.
    assert automaton.nodes == sum(7**n for n in range(1, 4))


def test_nodes_are_shared_by_words_with_the_same_end():
    rng = random.Random(3)
    ends = ["".join(rng.choice("uad") for _ in range(12)) for _ in range(4)]
    words = sorted({"".join(rng.choice("uaSd") for _ in range(3)) + e for e in ends for _ in range(40)},
                   key=lambda w: w[::-1])
    automaton = SuffixAutomaton()
    for word in words:
        table = EMPTY
        for symbol in word[::-1]:
            table = node_table(symbol, table)
        assert automaton.table(word) == table
    assert automaton.nodes == len({w[i:] for w in words for i in range(len(w))})


def test_followed_gives_the_repaired_roles():
    assert followed("sd", "KDII", 0) == (["", ""], ["k", ""], "ua")
    assert followed("aA", "IKIR", 0) == (["u", "u"], ["k", "a"], "")


ROWS = [
    *[(1, t, r, x) for t, r, x in [
        (0, "system", "Be kind."), (1, "user", "Hi."), (2, "assistant", "Yes"), (3, "user", "Hi."),
        (5, "assistant", "  \n"), (7, "assistant", "Done!  \t")]],
    (2, None, "user", "First."), (2, None, "user", "First."), (2, 4, "assistant", "Then."),
    (3, None, None, None), (None, 1, "user", "No id."), (None, 2, "assistant", "None."),
    (4, 1, "assistant", "a."), (4, 1, "user", "b."), (4, 1, "other", "c."), (4, 2, "User", "d."),
    (5, 3, "user", "ends with text é"), (5, 9, "assistant", "x" * 50_000 + "."), (6, -5, "user", "one?"),
    (7, 1, "user", "line\nbreak."), (7, 2, "assistant", "ok."), (8, 5, "system", "alone."),
]


def by_hand(rows):
    """The contract, row by row, in plain Python; rows of one turn by role and digest."""
    conversations: dict = {}
    for conv, turn, role, text in rows:
        conversations.setdefault(conv, [])
        shown = [" " if x is None else str(x) for x in (conv, turn)]
        kind = zlib.crc32(":".join(shown).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        row = (turn, "user" if kind == 4 else role, text)
        conversations[conv] += [row, row] if kind == 3 else [row]
    for conv, own in conversations.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(
            f"{len(r[1])}:{r[1]}:{r[2]}".encode()).hexdigest()))
        turns = {t for t, _, _ in own if t is not None}
        faults, seen = [], set()
        for _, role, text in own:
            kept = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not kept else "duplicate" if (role, text) in seen
                          else "truncated" if kept[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[1][:1] for r in own]
        symbols = ["d" if f in ("blank", "duplicate") else
                   (x if x in "sua" and x else "o").upper() if f else (x if x in "sua" and x else "o")
                   for f, x in zip(faults, initials, strict=True)]
        yield conv, own, faults, initials, "".join(symbols), (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit("x") for c in ("_id", "_key", "_block", "word", "table", "audit", "copy", "_copy", "lines")})
    repair = repair_conversations(damage(df), **options)
    return {r.conv_id: r for r in conversation_report(df, repair).collect()}


@pytest.mark.parametrize("options", [{}, {"block": 2, "hot_rows": 2}])
def test_equals_the_contract_by_hand(spark, options):
    rng = random.Random(8)
    rows = list(ROWS)
    for conv in range(100, 160):
        for turn in range(rng.randrange(5)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "tool"]),
                         rng.choice(["Yes.", "No", "", "Go on!", f"{turn}?"])))
    got = run(spark, rows, **options)
    assert set(got) == {r[0] for r in rows}
    for conv, own, faults, initials, symbols, gaps in by_hand(rows):
        r = got[conv]
        counted = Counter(faults)
        assert (r.gaps, r.blank, r.duplicate, r.truncated) == (
            gaps, counted["blank"], counted["duplicate"], counted["truncated"]), conv
        pairs = [a + b for a, b in zip(initials, initials[1:], strict=False)]
        assert r.illegal == sum(p not in ("su", "ua", "au") for p in pairs)
        table = EMPTY
        for x in reversed(symbols):
            table = node_table(x, table)
        cost, audit = of_table(table, symbols)
        assert (r.cost, r.audit) == (cost, audit), (conv, symbols)
        before, acts, tail = followed(symbols, audit, 0)
        names = {"u": "user", "a": "assistant"}
        lines = []
        for lead, act, (_, role, text) in zip(before, acts, own, strict=True):
            lines += [f"{names[x]}:" for x in lead]
            lines += [f"{names.get(act, role)}:{text}"] if act else []
        lines += [f"{names[x]}:" for x in tail]
        assert r.repaired_sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest()
        assert FORM.fullmatch("".join(x[0] for x in lines if x)) or any("\n" in x for x in lines)


def test_long_conversation_equals_sql_and_small_blocks(spark):
    """A third of all rows, and many copies, in one conversation."""
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "tool", "system"]),
             rng.choice(["Same.", "Open", f"No {t}.", f"Open {t}", " "])) for t in range(700)]
    rows += [(10 + c, t, ["user", "assistant"][t % 2], f"Turn {t}.") for c in range(300) for t in range(4)]
    small, large = run(spark, rows, block=3, hot_rows=5), run(spark, rows)
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    names = list(next(iter(small.values())).asDict())
    want = {r[0]: r for r in con.execute(f"select {', '.join(names)} from ({DIALOGUE_REPAIR})").fetchall()}
    assert {k: tuple(r) for k, r in small.items()} == want == {k: tuple(r) for k, r in large.items()}


def test_repaired_lines_have_the_form(spark):
    rows = [(c, t, r, f"{t}.") for c in range(20) for t, r in enumerate(["user", "user", "assistant", "system"])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    lines = repair_conversations(df).lines.orderBy("conv_id", "place").collect()
    for conv in range(20):
        own = [r for r in lines if r.conv_id == conv]
        assert FORM.fullmatch("".join(r.role[0] for r in own))
        assert all((r.edit == "I") == (r.text == "") for r in own)


def test_empty_table(spark):
    assert run(spark, []) == {}
