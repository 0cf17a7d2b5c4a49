"""Token ids and token counts of whole texts by the vocabulary of a public tokenizer.

A text is cut into units: a run of non-blank characters with the space before it, or
a run of blanks. The pre-tokenizer of byte-level vocabularies always cuts there, so
the ids of a text are the ids of its units in order, and each unit is encoded once.
Texts that hold one of the vocabulary's special strings are cut at it first, as the
library does.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np

from cohortloom.llm.spans import ASCII_BLANK, chunks, span_hashes

#: Blanks of the pre-tokenizer, by code point (Unicode White_Space).
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
UNIT = re.compile(f" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
BLANK_BYTES = frozenset(np.flatnonzero(ASCII_BLANK).tolist())
#: Units a task remembers.
MOST_UNITS = 1_000_000


def load(path: str):
    """The tokenizer of a .json file; one thread, as Spark runs a task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def cuts_at_blanks(tokenizer) -> bool:
    """Whether the vocabulary is byte-level with the usual pattern and no normaliser, and its
    special strings are plain ones: then units are encoded alone."""
    parts = json.loads(tokenizer.to_str())
    before = parts.get("pre_tokenizer") or {}
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"])
                for t in parts.get("added_tokens", []))
    return (parts.get("normalizer") is None and before.get("type") == "ByteLevel"
            and before.get("use_regex", True) and not before.get("add_prefix_space") and plain
            and (parts.get("post_processor") or {}).get("type") in (None, "ByteLevel"))


class Encoder:
    """Units of texts and the ids of units, remembered up to MOST_UNITS."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content: i for i, t in added.items()}
        self.split = re.compile("(" + "|".join(
            re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        self.by_unit = cuts_at_blanks(self.tokenizer)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.kind = "I" if self.wide else "H"
        self.known: dict[str, bytes] = {}
        self.store = UnitStore(self.kind)
        # Characters of a byte-level token stand for one byte each.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.token_bytes[list(vocabulary.values())] = list(map(len, vocabulary))
        self.odd = re.compile("|".join(
            [*map(re.escape, self.special), "[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"]))

    def odd_text(self, text: str) -> bool:
        """Whether a text holds a special string or a blank beyond ASCII."""
        if text.isascii():
            return any(s in text for s in self.special)
        return self.odd.search(text) is not None

    def units(self, text: str) -> list[str]:
        if not self.by_unit:
            return [text]
        if any(s in text for s in self.special):
            return [u for part in self.split.split(text) for u in (
                [part] if part in self.special else UNIT.findall(part))]
        return UNIT.findall(text)

    def encode(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    def learn(self, units: set[str]) -> None:
        """Encode the units that are not known yet, together."""
        new = [u for u in units if u not in self.known]
        if len(self.known) + len(new) > MOST_UNITS:
            self.known.clear()
            new = list(units)
        for start in range(0, len(new), 10_000):
            part = new[start:start + 10_000]
            self.known.update(zip(part, (array(self.kind, ids).tobytes() for ids in self.encode(part)),
                                  strict=True))

    def ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in the narrowest type the vocabulary allows."""
        if not self.by_unit:
            yield from map(self._one_by_one, texts)
            return
        # Texts with special strings or with blanks beyond ASCII are cut by the pattern.
        plain = [not self.odd_text(t) for t in texts]
        found = iter(self._together([t.encode() for t, p in zip(texts, plain, strict=True) if p]))
        for text, together in zip(texts, plain, strict=True):
            yield next(found) if together else self._one_by_one(text)

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of units in one array, and per unit where its own start and how many they are.

        Words behind a space may stand together in one text, since it is cut at the
        spaces; where a unit ends is told by the bytes of its tokens.
        """
        lengths, offsets = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        parts, size = [], 0
        words = [i for i, u in enumerate(units) if len(u) > 1 and u[0] == 0x20
                 and u[1] not in BLANK_BYTES]
        groups = [words[i:i + 500] for i in range(0, len(words), 500)]
        texts = [b"".join([units[i] for i in g]).decode() for g in groups]
        alone = sorted(set(range(len(units))).difference(words))
        for group, ids in zip(groups, self.encode(texts), strict=True):
            ids = np.array(ids, self.kind)
            ends = np.cumsum(self.token_bytes[ids])
            wanted = np.cumsum([len(units[i]) for i in group])
            places = np.searchsorted(ends, wanted) + 1
            if not len(ends) or (ends[np.minimum(places, len(ends)) - 1] != wanted).any():
                alone += group
                continue
            lengths[group] = np.diff(places, prepend=0)
            offsets[group] = size + places - lengths[group]
            parts.append(ids)
            size += len(ids)
        for i, ids in zip(alone, self.encode([units[i].decode() for i in alone]), strict=True):
            offsets[i], lengths[i] = size, len(ids)
            parts.append(np.array(ids, self.kind))
            size += len(ids)
        return np.concatenate(parts) if parts else np.empty(0, self.kind), offsets, lengths

    def _one_by_one(self, text: str) -> np.ndarray:
        row = self.units(text)
        self.learn(set(row))
        return np.frombuffer(b"".join(map(self.known.__getitem__, row)), self.kind)

    def _together(self, texts: list[bytes]) -> list[np.ndarray]:
        rows: list[list[np.ndarray]] = [[] for _ in texts]
        for parts in chunks(texts):
            joined = b"".join(p for _, p in parts)
            at = np.cumsum([0, *(len(p) for _, p in parts)])
            starts, ends = unit_places(joined, at[:-1])
            codes, some, which = np.unique(
                span_hashes(np.frombuffer(joined, np.uint8), starts, ends),
                return_index=True, return_inverse=True)
            slots = self.store.slots(codes, lambda new: [
                joined[a:b] for a, b in zip(starts[some[new]].tolist(), ends[some[new]].tolist(),
                                            strict=True)], self.encode_units)
            if (self.store.sizes()[slots[which]] != ends - starts).any():
                raise ValueError("two units of different length have one hash")
            ids, bounds = self.store.gather(slots[which], np.searchsorted(starts, at))
            for (number, _), a, b in zip(parts, bounds[:-1], bounds[1:], strict=True):
                rows[number].append(ids[a:b])
        none = np.empty(0, self.kind)
        return [own[0] if len(own) == 1 else np.concatenate(own) if own else none for own in rows]


def unit_places(joined: bytes, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the units of texts that stand one after the other, those of UNIT.

    Blanks are ASCII. A run of blanks is a unit of its own, but for its last one before a
    word: a space belongs to the word, any other is a unit.
    """
    data = np.frombuffer(joined, np.uint8)
    blank = ASCII_BLANK[data]
    before = np.empty_like(blank)
    before[1:] = blank[:-1]
    before[firsts] = False
    opens = blank & ~before
    opens[firsts] = True
    words = np.flatnonzero(~blank & before)
    opens[words - 1] = True
    opens[words[data[words - 1] != 0x20]] = True
    starts = np.flatnonzero(opens)
    return starts, np.append(starts[1:], len(data))


class UnitStore:
    """Ids of units by the units' hashes, in one growing array."""

    def __init__(self, kind: str):
        self.kind = kind
        self.clear()

    def clear(self) -> None:
        self.known: dict[int, int] = {}
        self.flat, self.offsets, self.lengths = array(self.kind), array("q"), array("q")
        self.bytes = array("q")

    def sizes(self) -> np.ndarray:
        return np.array(self.bytes, np.int64)

    def slots(self, codes: np.ndarray, units_of, encode) -> np.ndarray:
        """The slot of each distinct hash; new units are encoded together."""
        if len(self.known) + len(codes) > MOST_UNITS:
            self.clear()
        keys = codes.tolist()
        found = np.fromiter(map(self.known.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(found < 0)
        if len(new):
            units = units_of(new)
            ids, offsets, lengths = encode(units)
            first = len(self.offsets)
            found[new] = np.arange(first, first + len(new))
            self.known.update(zip(codes[new].tolist(), range(first, first + len(new)), strict=True))
            self.offsets.frombytes((offsets + len(self.flat)).tobytes())
            self.lengths.frombytes(lengths.tobytes())
            self.bytes.extend(map(len, units))
            self.flat.frombytes(ids.tobytes())
        return found

    def gather(self, slots: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the slots one after the other, and where each group of them starts."""
        lengths = np.array(self.lengths, np.int64)[slots]
        ends = np.cumsum(lengths)
        shift = ends - lengths - np.array(self.offsets, np.int64)[slots]
        places = np.arange(ends[-1] if len(ends) else 0) - np.repeat(shift, lengths)
        return np.array(self.flat, self.kind)[places], np.concatenate([[0], ends])[bounds]


ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file; workers outlive tasks."""
    if path not in ENCODERS:
        ENCODERS[path] = Encoder(path)
    return ENCODERS[path]
