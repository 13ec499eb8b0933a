"""Byte-level BPE over whole texts, counted by distinct pre-token.

A byte-level BPE model cuts a text into pre-tokens and merges inside each of them. Here a
batch of texts is cut with array operations on code points, pre-tokens are looked up by
64-bit keys, and every distinct pre-token is encoded once. A key only finds: the code points of each pre-token
are compared with those of the one it found, and where they differ it is encoded by itself. The library remains the authority: it
encodes all pre-tokens that are not proven whole tokens, and it takes over a text entirely if the text holds
a special string or a code point that Unicode tables of different versions class differently.
"""

from __future__ import annotations

import functools
import os
import unicodedata
from collections.abc import Iterator

import numpy as np

from tablewharf.llm.common import only_one

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Code points cut at a time; a longer text is cut in windows of this size.
WINDOW = 1 << 20
# Merged pre-tokens that a worker remembers; beyond it, the memory starts anew.
REMEMBERED = 800_000

SPACE, LETTER, NUMBER, OTHER, UNSURE = range(5)
BASE = np.uint64(0x9E3779B97F4A7C15)
FIRST = np.uint64(0xBF58476D1CE4E5B9)
SECOND = np.uint64(0x94D049BB133111EB)

# The contractions that the pre-tokenizer splits off, without the apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point; unassigned ones are unsure."""
    kinds = np.full(0x110000, OTHER, dtype=np.uint8)
    first = {"L": LETTER, "N": NUMBER}
    for point in range(0x110000):
        char = chr(point)
        category = unicodedata.category(char)
        if category == "Cn":
            kinds[point] = UNSURE
        elif category[0] in first:
            kinds[point] = first[category[0]]
        elif char.isspace() and not 0x1C <= point <= 0x1F:
            kinds[point] = SPACE
    return kinds


@functools.cache
def byte_signs() -> dict[int, str]:
    """The printable sign by which byte-level vocabularies write each byte: itself if it is
    printable in Latin-1, else the next code point from 256."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(256 + i) for i, b in enumerate(rest)}


def token_starts(points: np.ndarray, kinds: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where pre-tokens start in texts that stand one after the other.

    The rules of the byte-level pattern: runs of letters, of numbers and of other signs, each
    with one blank before it; white space up to the last sign before such a run; contractions.
    """
    n = len(points)
    opens = np.zeros(n + 1, dtype=bool)
    opens[text_starts] = True
    opens[n] = True
    space = kinds == SPACE
    change = np.empty(n + 1, dtype=bool)
    change[0] = change[n] = True
    np.not_equal(kinds[1:], kinds[:-1], out=change[1:n])
    change |= opens
    starts = change[:n].copy()
    # The last white space before a run stands apart, and a blank there opens the run.
    last = np.zeros(n, dtype=bool)
    last[: n - 1] = space[: n - 1] & ~space[1:] & ~opens[1:n]
    starts |= last
    joined = np.zeros(n, dtype=bool)
    joined[1:] = last[:-1] & (points[:-1] == 32)
    starts &= ~joined
    # A lone apostrophe that opens a pre-token takes the letters of a contraction with it.
    quotes = np.flatnonzero((points == 39) & starts & change[1:])
    if len(quotes):
        padded = np.concatenate([points, np.zeros(3, dtype=points.dtype)])
        taken = np.zeros(len(quotes), dtype=np.int64)
        for word in CONTRACTIONS:
            fits = taken == 0
            for k, char in enumerate(word):
                at = quotes + 1 + k
                fits &= (padded[at] == ord(char)) & ~opens[np.minimum(at, n)]
            taken[fits] = len(word)
        quotes, taken = quotes[taken > 0], taken[taken > 0]
        starts[quotes + 1] = False
        after = quotes + 1 + taken
        starts[after[after < n]] = True
    return np.flatnonzero(starts)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * FIRST
    values = (values ^ (values >> np.uint64(27))) * SECOND
    return values ^ (values >> np.uint64(31))


class PreTokens:
    """Encodes batches of texts with a tokenizer file; keeps what it has merged."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.proven = self._whole_tokens()
        self._restart()

    def _whole_tokens(self) -> list[tuple[str, int]]:
        """Vocabulary strings that the model encodes, alone, as their own one token."""
        decoded = [(i, self.tokenizer.decode([i], skip_special_tokens=False)) for i in range(self.tokenizer.get_vocab_size())]
        known = [(i, text) for i, text in decoded if text and "�" not in text and text not in self.special]
        alone = self.tokenizer.encode_batch([text for _, text in known], add_special_tokens=False)
        return [(text, i) for (i, text), found in zip(known, alone) if found.ids == [i]]

    def _restart(self) -> None:
        """Know the proven whole tokens only. Entry number ``e`` has ``counts[e]`` ids from ``first[e]`` and ``sizes[e]``
        code points from ``at[e]``; ``keys`` in order name ``entries``."""
        none = np.empty(0, dtype=np.int64)
        self.counts, self.first, self.sizes, self.at = none, none, none, none
        self.ids, self.points = np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.uint32)
        self.keys, self.entries = np.empty(0, dtype=np.uint64), none
        texts = [text for text, _ in self.proven]
        numbers = self._enter(texts, [[i] for _, i in self.proven])
        keys, first = np.unique(self._keys(self.points, self.at, self.at + self.sizes), return_index=True)
        self.keys, self.entries = keys, numbers[first]

    @staticmethod
    def _keys(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Keys of pre-tokens that adjoin: sums of the scrambled pairs of place and code point."""
        place = np.arange(1, len(points) + 1) - np.repeat(starts, ends - starts)
        pairs = _mixed(place.astype(np.uint64) * BASE + points)
        return _mixed(np.add.reduceat(pairs, starts) + (ends - starts).astype(np.uint64))

    def _enter(self, texts: list[str], encoded: list[list[int]]) -> np.ndarray:
        """Append entries; their numbers."""
        counts = np.array([len(e) for e in encoded], dtype=np.int64)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        number = len(self.counts) + np.arange(len(texts))
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(counts) - counts])
        self.at = np.concatenate([self.at, len(self.points) + np.cumsum(sizes) - sizes])
        self.counts, self.sizes = np.concatenate([self.counts, counts]), np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, np.array([i for e in encoded for i in e], dtype=np.uint32)])
        self.points = np.concatenate([self.points, np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)])
        return number

    def _merged(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Entries for pre-tokens that the model merges now."""
        table, merge = byte_signs(), self.tokenizer.model.tokenize
        texts = [points[a:b].tobytes().decode("utf-32-le") for a, b in zip(starts, ends)]
        return self._enter(texts, [[t.id for t in merge(text.encode().decode("latin-1").translate(table))] for text in texts])

    def _find(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The entry of every pre-token; pre-tokens adjoin and fill ``points``."""
        keys = self._keys(points, starts, ends)
        distinct, sample, inverse = np.unique(keys, return_index=True, return_inverse=True)

        def known() -> np.ndarray:
            place = np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)
            return np.where(self.keys[place] == distinct, self.entries[place], -1)

        found = known()
        if (found < 0).any() and len(self.counts) + len(distinct) > REMEMBERED + len(self.proven):
            self._restart()
            found = known()
        new = np.flatnonzero(found < 0)
        if len(new):
            found[new] = self._merged(points, starts[sample[new]], ends[sample[new]])
            place = np.searchsorted(self.keys, distinct[new])
            self.keys, self.entries = np.insert(self.keys, place, distinct[new]), np.insert(self.entries, place, found[new])
        entries = found[inverse]
        wrong = np.flatnonzero(self._differs(entries, points, starts, ends - starts))
        if len(wrong):
            entries[wrong] = self._merged(points, starts[wrong], ends[wrong])
        return entries

    def _differs(self, entries: np.ndarray, points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the code points of a pre-token are not those of its entry."""
        wrong = self.sizes[entries] != sizes
        there = np.repeat(self.at[entries] - starts, sizes) + np.arange(len(points))
        if wrong.any():
            there = np.minimum(there, len(self.points) - 1)
        other = self.points[there] != points
        return wrong | np.logical_or.reduceat(other, starts) if other.any() else wrong

    def encode(self, texts: list[str], want_ids: bool) -> Iterator[tuple[int, int, np.ndarray | None]]:
        """``(index of the text, tokens, ids)`` for parts of texts in order; long texts come in several parts."""
        kinds_of = classes()
        waiting: list[tuple[int, np.ndarray]] = []
        size = 0
        for index, text in enumerate(texts):
            if not text:
                continue
            points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
            if any(s in text for s in self.special) or (kinds_of[points] == UNSURE).any():
                yield from self._flush(waiting, want_ids)
                waiting, size = [], 0
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                yield index, len(ids), np.array(ids, dtype=np.uint32)
            elif len(points) > WINDOW:
                yield from self._flush(waiting, want_ids)
                waiting, size = [], 0
                yield from self._long(index, points, want_ids)
            else:
                if size + len(points) > WINDOW:
                    yield from self._flush(waiting, want_ids)
                    waiting, size = [], 0
                waiting.append((index, points))
                size += len(points)
        yield from self._flush(waiting, want_ids)

    def _flush(self, waiting: list[tuple[int, np.ndarray]], want_ids: bool) -> Iterator[tuple[int, int, np.ndarray | None]]:
        if not waiting:
            return
        points = np.concatenate([p for _, p in waiting])
        edges = np.concatenate([[0], np.cumsum([len(p) for _, p in waiting])])
        starts = token_starts(points, classes()[points], edges[:-1])
        places = self._find(points, starts, np.append(starts[1:], len(points)))
        cuts = np.searchsorted(starts, edges)
        for (index, _), a, b in zip(waiting, cuts, cuts[1:]):
            yield index, int(self.counts[places[a:b]].sum()), self._ids(places[a:b]) if want_ids else None

    def _ids(self, places: np.ndarray) -> np.ndarray:
        counts = self.counts[places]
        if not len(counts):
            return np.empty(0, dtype=np.uint32)
        ends = np.cumsum(counts)
        shift = np.repeat(self.first[places] - (ends - counts), counts)
        return self.ids[np.arange(ends[-1]) + shift]

    def _long(self, index: int, points: np.ndarray, want_ids: bool) -> Iterator[tuple[int, int, np.ndarray | None]]:
        """Windows over one text; each ends where a pre-token certainly starts."""
        at, width = 0, WINDOW
        while at < len(points):
            part = points[at : at + width]
            starts = token_starts(part, classes()[part], np.array([0]))
            if at + width < len(points):
                if len(starts) < 3:
                    if width >= 2 * WINDOW:  # a pre-token without end: leave the rest to the library
                        ids = self.tokenizer.encode(points[at:].tobytes().decode("utf-32-le"), add_special_tokens=False).ids
                        yield index, len(ids), np.array(ids, dtype=np.uint32)
                        return
                    width = 2 * WINDOW
                    continue
                end = starts[-2]
                part, starts = part[:end], starts[:-2]
            places = self._find(part, starts, np.append(starts[1:], len(part)))
            yield index, int(self.counts[places].sum()), self._ids(places) if want_ids else None
            at, width = at + len(part), WINDOW


def pre_tokens(path: str) -> PreTokens:
    """One encoder for each worker process and file."""
    return only_one(("pre-tokens", path), lambda: PreTokens(path))
