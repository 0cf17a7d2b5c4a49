"""Conversation structure repair at least cost, with one automaton for all conversations.

A conversation is a word: one symbol per row, of its role's initial and its fault. Words
are cut into blocks and read from their ends. Distinct words in the order of their
reversed symbols share suffixes, so each suffix is a node that is met once: from it,
for every grammar state before and after, the least cost of its edits and the least
audit among the cheapest are computed once, from the node of the suffix one shorter.
Blocks then only look up their word. Their costs are added up from the last block to
the first, and the edits are followed from the first to the last.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.common import GAP, written
from cohortloom.llm.url_templates import HOT_ROWS, spread_join

#: Rows of one block.
BLOCK = 64
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Grammar states: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a row of this initial, where it is allowed. "o" is any other initial.
ALLOWED = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
           "a": {USER: ASSISTANT}, "o": {}}
#: The state after the one role an inserted or re-roled row may have.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: Rows to insert at the end of a conversation that stops in a state.
MISSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
#: The symbol of a row that has to go; sound rows have their initial, truncated ones its capital.
GONE = "d"

#: Per state before: per state after, the least (cost, audit).
Table = dict[int, dict[int, tuple[int, str]]]
EMPTY: Table = {s: {s: (0, "")} for s in range(4)}


def row_edits(symbol: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(audit, cost, state after) of a row and of rows inserted before it."""
    inserted = ""
    for _ in range(3):  # A third insertion leads back to the state after the first.
        cost = INSERT * len(inserted)
        yield inserted + "D", cost + DELETE, state
        if symbol != GONE:
            broken = TRUNCATED * symbol.isupper()
            if state in ALLOWED[symbol.lower()]:
                yield inserted + "K", cost + broken, ALLOWED[symbol.lower()][state]
            yield inserted + "R", cost + broken + REROLE, NEXT[state]
        inserted, state = inserted + "I", NEXT[state]


EDITS = {(x, s): list(row_edits(x, s)) for x in "suaoSUAO" + GONE for s in range(4)}


def node_table(symbol: str, rest: Table) -> Table:
    """The table of a suffix from that of the suffix without its first symbol.

    Of two audits from one state to another the lesser is lesser whatever follows: with
    as many rows, and insertions only before rows, none is a prefix of another.
    """
    table: Table = {}
    for state in range(4):
        best: dict[int, tuple[int, str]] = {}
        for audit, cost, then in EDITS[symbol, state]:
            for end, (more, after) in rest[then].items():
                found = (cost + more, audit + after)
                if end not in best or found < best[end]:
                    best[end] = found
        table[state] = best
    return table


class SuffixAutomaton:
    """Nodes of the suffixes of words that come in the order of their reversed symbols.

    Only the nodes of the last word are held: in that order no other is met again.
    """

    def __init__(self) -> None:
        self.symbols = ""
        self.tables = [EMPTY]
        self.nodes = 0

    def table(self, word: str) -> Table:
        turned = word[::-1]
        shared = 0
        for a, b in zip(self.symbols, turned, strict=False):
            if a != b:
                break
            shared += 1
        del self.tables[shared + 1:]
        for symbol in turned[shared:]:
            self.tables.append(node_table(symbol, self.tables[-1]))
            self.nodes += 1
        self.symbols = turned
        return self.tables[-1]


def from_the_end(table: Table, togo: dict[int, int], last: bool) -> list[tuple[int, str, int] | None]:
    """Per state before a block: the state after it, the audit and the cost to the end."""
    out: list[tuple[int, str, int] | None] = []
    for state in range(4):
        ways = [(cost + togo[end], audit + "I" * (MISSING[end] if last else 0), end)
                for end, (cost, audit) in table[state].items() if end in togo]
        out.append((lambda c, a, e: (e, a, c))(*min(ways)) if ways else None)
    return out


def followed(word: str, audit: str, state: int) -> tuple[list[str], list[str], str]:
    """Per row: roles inserted before it, and what becomes of it ("k" kept, "u" or "a" the
    new role, "" deleted); and the roles inserted after the last."""
    before, acts = [], []
    pieces = re.findall("I*[KRD]", audit)
    letters = {USER: "u", ASSISTANT: "a"}
    for symbol, piece in zip(word, pieces, strict=True):
        lead = ""
        for _ in piece[:-1]:
            state = NEXT[state]
            lead += letters[state]
        before.append(lead)
        if piece[-1] == "D":
            acts.append("")
        elif piece[-1] == "K":
            state = ALLOWED[symbol.lower()][state]
            acts.append("k")
        else:
            state = NEXT[state]
            acts.append(letters[state])
    tail = ""
    for _ in audit[sum(map(len, pieces)):]:
        state = NEXT[state]
        tail += letters[state]
    return before, acts, tail


def illegal_pairs(roles: str) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))


# -- tables ----------------------------------------------------------------------------

def key_of(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit("a"), conv.cast("string")), F.lit("b"))


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text") -> DataFrame:
    """The rows with the faults their conversation and turn draw, in the columns conv_id,
    turn, role and text: 1 of 20 is dropped, 1 emptied, 1 loses its sentence ends, 1 is
    repeated, 1 is given the role user. Null roles and texts are one space."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown(conv), F.lit(":"), shown(turn))) % 20
    body = F.when(kind == 1, F.lit("")).when(
        kind == 2, F.translate(shown(text), ".!?", "")).otherwise(shown(text))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.where(kind != 0).select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(shown(role)).alias("role"),
        body.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def marked(rows: DataFrame) -> DataFrame:
    """Adds _dup to the narrow rows: an earlier row has the same role and text.

    Of equal rows the one with the lowest _id is first. Groups are only aggregated.
    """
    first = rows.where(~F.col("_blank")).groupBy("_key", "_digest").agg(
        F.min(F.struct(F.col("turn").isNotNull(), "turn", "_id")).alias("_first"))
    return rows.join(first.select(F.col("_first._id").alias("_id"), F.lit(True).alias("_is")),
                     "_id", "left").withColumn(
        "_dup", ~F.col("_blank") & F.col("_is").isNull()).drop("_is")


def arrow_pass(df: DataFrame, schema: str, run) -> DataFrame:
    """``run`` goes once over the rows of each partition, in their order."""
    kinds = T.StructType.fromDDL(schema)

    def go(batches):
        for rows in run(row for batch in batches for row in batch.to_pylist()):
            yield pa.RecordBatch.from_pylist(rows, schema=to_arrow(kinds))

    return df.mapInArrow(go, kinds)


def to_arrow(kinds: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(kinds)


def in_pieces(rows: Iterable[dict], most: int = 2000) -> Iterator[list[dict]]:
    piece: list[dict] = []
    for row in rows:
        piece.append(row)
        if len(piece) == most:
            yield piece
            piece = []
    yield piece


def word_tables(words: DataFrame) -> DataFrame:
    """Per distinct ``word``: table, a list of (state, end, cost, audit)."""
    def run(rows):
        automaton = SuffixAutomaton()
        return in_pieces({"word": r["word"], "n": r["n"], "table": [
            {"state": s, "end": e, "cost": c, "audit": a}
            for s, ends in automaton.table(r["word"]).items() for e, (c, a) in ends.items()]}
            for r in rows)

    turned = words.withColumn("_turned", F.reverse("word"))
    ordered = turned.repartitionByRange("_turned").sortWithinPartitions("_turned").drop("_turned")
    return arrow_pass(ordered, "word string, n long, table array<struct<state int, end int, "
                               "cost long, audit string>>", run)


def least_edits(blocks: DataFrame) -> DataFrame:
    """Per block: audit, cost of the conversation from here on, and the edits of its rows.

    Blocks of a conversation go through one task one after the other, twice; only the
    costs of four states are held.
    """
    def backwards(rows):
        def out():
            key, togo = None, {}
            for r in rows:
                last = r["_key"] != key
                if last:
                    key, togo = r["_key"], {s: INSERT * n for s, n in MISSING.items()}
                table: Table = {s: {} for s in range(4)}
                for x in r["table"]:
                    table[x["state"]][x["end"]] = (x["cost"], x["audit"])
                ways = from_the_end(table, togo, last)
                togo = {s: w[2] for s, w in enumerate(ways) if w}
                yield {**{c: r[c] for c in ("_key", "_block", "word", "roles")}, "ways": [
                    w and {"end": w[0], "audit": w[1], "cost": w[2]} for w in ways]}
        return in_pieces(out())

    def forwards(rows):
        def out():
            key, state, role = None, START, ""
            for r in rows:
                if r["_key"] != key:
                    key, state, role = r["_key"], START, ""
                way = r["ways"][state]
                lead, acts, tail = followed(r["word"], way["audit"], state)
                yield {"_key": key, "_block": r["_block"], "audit": way["audit"],
                       "cost": way["cost"], "illegal": illegal_pairs(role + r["roles"]),
                       "lead": lead, "acts": acts, "tail": tail}
                state, role = way["end"], r["roles"][-1]
        return in_pieces(out())

    names = "_key string, _block long, word string, roles string"
    back = arrow_pass(
        blocks.select("_key", "_block", "word", "roles", "table").repartition("_key")
        .sortWithinPartitions("_key", F.col("_block").desc()),
        f"{names}, ways array<struct<end int, audit string, cost long>>", backwards)
    return arrow_pass(
        back.repartition("_key").sortWithinPartitions("_key", "_block"),
        "_key string, _block long, audit string, cost long, illegal long, "
        "lead array<string>, acts array<string>, tail string", forwards)


@dataclass(frozen=True)
class Repair:
    """``report``: one row per conversation with rows: conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit. ``lines``: the repaired conversations: conv_id, place
    (three numbers that order them), role, text, edit (K, R or I)."""

    report: DataFrame
    lines: DataFrame


def repair_conversations(rows: DataFrame, *, block: int = BLOCK, hot_rows: int = HOT_ROWS) -> Repair:
    """The cheapest edits that give each conversation the form of an optional system row
    and one or more pairs of user and assistant rows, or none at all.

    ``rows`` has conv_id, turn, role and text. Rows stand by turn, nulls first; rows of
    one turn by role and digest of the text. Blank rows, and rows whose role and text
    were seen earlier, have to go; rows that do not end a sentence cost more to keep.
    Null roles and texts are one space; a null conv_id is a conversation; an empty role
    has no initial and can only be re-roled or deleted. Equal rows are each a row. An
    empty table gives no rows. Other columns are not read.

    A conversation of any length is spread over tasks for its faults, its order and its
    words; only blocks of ``block`` rows, as words without texts, go through one task.
    """
    text = F.coalesce("text", F.lit(" "))
    role = F.coalesce("role", F.lit(" "))
    last = F.regexp_extract(text, f"([^{GAP}])[{GAP}]*\\z", 1)
    stored = written(rows.select(
        F.monotonically_increasing_id().alias("_id"), "conv_id", key_of(F.col("conv_id")).alias("_key"),
        F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.sha2(F.concat_ws(":", F.length(role), role, text), 256).alias("_digest"),
        (last == "").alias("_blank"), (~last.isin(".", "!", "?")).alias("_open")), "turns")
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    narrow = marked(stored.select("_id", "_key", "turn", initial.alias("_initial"), "role",
                                  "_digest", "_blank", "_open"))
    gone = F.col("_blank") | F.col("_dup")
    narrow = narrow.withColumns({
        "_cut": F.col("_open") & ~gone,
        "_symbol": F.when(gone, F.lit(GONE)).when(F.col("_open"), F.upper("_initial"))
        .otherwise(F.col("_initial"))}).drop("_open")
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("_digest"), F.col("_id")]
    # Stored, so that a lost task cannot draw other bounds than its neighbours had.
    placed = written(narrow.repartitionByRange("_key", *order).withColumn(
        "_part", F.spark_partition_id().cast("long")), "placed-turns")
    number = F.row_number().over(Window.partitionBy("_key", "_part").orderBy(*order)) - 1
    placed = placed.select(
        "_id", "_key", "_symbol", "_initial",
        (F.shiftleft("_part", 32) + F.floor(number / block)).alias("_block"),
        (number % block).cast("int").alias("_pos"))
    placed = written(placed, "blocks-of-turns")
    gathered = placed.groupBy("_key", "_block").agg(
        F.sort_array(F.collect_list(F.struct("_pos", "_symbol", "_initial"))).alias("_rows"))
    blocks = written(gathered.select(
        "_key", "_block", F.array_join("_rows._symbol", "").alias("word"),
        F.array_join("_rows._initial", "").alias("roles")), "words")
    tables = written(word_tables(blocks.groupBy("word").agg(F.count(F.lit(1)).alias("n"))),
                     "word-tables")
    edits = written(least_edits(spread_join(blocks, tables, ["word"], ["table"], "n", hot_rows)),
                    "edits")
    names = stored.groupBy("_key").agg(
        F.max("conv_id").alias("conv_id"), F.count_if("_blank").alias("blank"))
    faults = narrow.groupBy("_key").agg(
        F.count_if("_dup").alias("duplicate"), F.count_if("_cut").alias("truncated"))
    gaps = stored.where(F.col("turn").isNotNull()).select("_key", "turn").distinct().groupBy(
        "_key").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    audits = edits.groupBy("_key").agg(
        F.sum("illegal").alias("illegal"), F.min_by("cost", "_block").alias("cost"),
        F.sort_array(F.collect_list(F.struct("_block", "audit"))).alias("_audits"))
    report = names.join(faults, "_key").join(audits, "_key").join(gaps, "_key", "left").select(
        "conv_id", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate",
        "truncated", "illegal", "cost", F.array_join("_audits.audit", "").alias("audit"))

    def inserted(letters: Column) -> Column:
        return F.transform(F.filter(F.split(letters, ""), lambda x: x != ""), lambda x: F.struct(
            F.when(x == "u", F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
            F.lit("").alias("text"), F.lit("I").alias("edit")))

    each = edits.select("_key", "_block", "tail", F.size("acts").alias("_n"), F.posexplode(
        F.arrays_zip("lead", "acts")).alias("_pos", "_edit"))
    each = placed.select("_id", "_key", "_block", "_pos").join(
        each, ["_key", "_block", "_pos"]).select(
            "_id", "_block", "_pos", F.col("_edit.lead").alias("lead"), F.col("_edit.acts").alias("act"),
            F.when(F.col("_pos") == F.col("_n") - 1, F.col("tail")).otherwise(F.lit("")).alias("tail"))
    each = each.where((F.col("lead") != "") | (F.col("act") != "") | (F.col("tail") != ""))
    # A row that goes leaves its text behind before the shuffle.
    act = F.col("act")
    own = F.when(act == "k", F.array(F.struct("role", "text", F.lit("K").alias("edit")))).when(
        act != "", F.array(F.struct(
            F.when(act == "u", F.lit("user")).otherwise(F.lit("assistant")).alias("role"), "text",
            F.lit("R").alias("edit")))).otherwise(
        F.array().cast("array<struct<role:string,text:string,edit:string>>"))
    lines = stored.select("_id", "conv_id", "role", "text").join(each, "_id").select(
        "conv_id", "_block", "_pos", F.posexplode(
            F.concat(inserted(F.col("lead")), own, inserted(F.col("tail")))).alias("_at", "_line"))
    return Repair(report, lines.select(
        "conv_id", F.struct("_block", "_pos", "_at").alias("place"), "_line.*"))


def line_digests(lines: DataFrame) -> DataFrame:
    """Per conversation the SHA-256 of its lines ``role:text``, joined by newlines.

    The hash has to see a conversation's bytes one after the other, so they stream
    through one task; none are held.
    """
    def run(rows):
        def out():
            key, digest = None, None
            for r in rows:
                if r["_key"] != key:
                    if digest is not None:
                        yield {"_key": key, "repaired_sha256": digest.hexdigest()}
                    key, digest = r["_key"], hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(r["line"])
            if digest is not None:
                yield {"_key": key, "repaired_sha256": digest.hexdigest()}
        return in_pieces(out())

    line = F.encode(F.concat_ws(":", "role", "text"), "UTF-8").alias("line")
    ordered = lines.select(key_of(F.col("conv_id")).alias("_key"), "place", line).repartition(
        "_key").sortWithinPartitions("_key", "place").drop("place")
    return arrow_pass(ordered, "_key string, repaired_sha256 string", run)


def conversation_report(conversations: DataFrame, repair: Repair, conv: str = "conv_id") -> DataFrame:
    """The report and the digest of every conversation id of ``conversations``; those
    without rows in the repair have zeros, an empty audit and the digest of nothing."""
    every = conversations.select(F.col(conv).alias("conv_id")).distinct().withColumn(
        "_key", key_of(F.col("conv_id")))
    found = repair.report.withColumn("_key", key_of(F.col("conv_id"))).drop("conv_id")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    joined = every.join(found, "_key", "left").join(line_digests(repair.lines), "_key", "left")
    return joined.select(
        F.col("conv_id").alias(conv), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
