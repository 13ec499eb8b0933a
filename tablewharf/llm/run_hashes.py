"""CRC-32 of all runs of words of many texts at once.

CRC-32 is linear: the crc of some bytes is the exclusive or of what every byte adds at its distance from the end,
and of the crc of as many zero bytes. So words are hashed with one look-up a byte, and a run of words
from the hashes of the shorter run and of its last word.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np

# Bytes that are hashed at a time; longer texts are cut in windows of this size.
WINDOW = 1 << 20
# Longest word that the tables cover; runs with a longer one are hashed one by one.
PLACES = 1024


@functools.cache
def letters() -> np.ndarray:
    """What each byte is inside a word: a-z for A-Z, itself for digits, a-z and bytes beyond ASCII, else 0."""
    found = np.zeros(256, dtype=np.uint8)
    for byte in range(256):
        char = chr(byte)
        if byte >= 0x80 or char.isdigit() or "a" <= char <= "z":
            found[byte] = byte
        elif "A" <= char <= "Z":
            found[byte] = ord(char.lower())
    return found


@functools.cache
def adds() -> np.ndarray:
    """``adds()[d, b]``: what byte ``b`` adds to the crc of bytes that end ``d`` bytes after it."""
    zero = zlib.crc32(b"\0")
    table = np.empty((PLACES + 2, 256), dtype=np.uint32)
    table[0] = [zlib.crc32(bytes([b])) ^ zero for b in range(256)]
    for place in range(1, PLACES + 2):
        before = table[place - 1]
        table[place] = (before >> np.uint32(8)) ^ table[0][before & np.uint32(255)]
    return table


@functools.cache
def shifts() -> np.ndarray:
    """``shifts()[n, k, b]``: what byte ``k`` of a hash, if it is ``b``, becomes when ``n`` bytes follow."""
    table = np.empty((PLACES + 2, 4, 256), dtype=np.uint32)
    for k in range(4):
        table[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, PLACES + 2):
        before = table[n - 1]
        table[n] = (before >> np.uint32(8)) ^ adds()[0][before & np.uint32(255)]
    return table


@functools.cache
def zeros(size: int) -> np.ndarray:
    """The crc of so many zero bytes."""
    found, crc = np.empty(size + 1, dtype=np.uint32), 0
    for n in range(size + 1):
        found[n] = crc
        crc = zlib.crc32(b"\0", crc)
    return found


def _shifted(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    table = shifts()
    out = table[sizes, 0, hashes & np.uint32(255)]
    for k in range(1, 4):
        out ^= table[sizes, k, (hashes >> np.uint32(8 * k)) & np.uint32(255)]
    return out


class Window:
    """Words of some bytes and the crc of their runs; ``owner`` names the text of each word."""

    def __init__(self, data: bytes, edges: np.ndarray) -> None:
        signs = letters()[np.frombuffer(data, dtype=np.uint8)]
        inside = np.concatenate([[False], signs != 0, [False]])
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = turns[::2], turns[1::2]
        self.owner = np.searchsorted(edges, self.starts, side="right") - 1
        self.signs = signs

    def hashes(self, grams: int, known: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(last word, crc)`` of the runs of 1 to ``grams`` words of one text that end after the first ``known`` words."""
        sizes = self.ends - self.starts
        if not len(sizes):
            return
        long = sizes > PLACES
        covered = np.where(long, 0, sizes)
        first = np.cumsum(covered) - covered
        place = np.arange(int(covered.sum())) - np.repeat(first, covered)
        signs = self.signs[place + np.repeat(self.starts, covered)]
        parts = adds()[np.repeat(covered, covered) - 1 - place, signs]
        words = np.zeros(len(sizes), dtype=np.uint32)
        if len(parts):
            words[~long] = np.bitwise_xor.reduceat(parts, first[~long])
        last = np.arange(len(sizes))
        runs, total, odd = words, covered, long
        blank = adds()[covered, 32]
        for n in range(1, grams + 1):
            if n > 1:
                runs = _shifted(runs[:-1], covered[n - 1 :] + 1) ^ blank[n - 1 :] ^ words[n - 1 :]
                total, odd = total[:-1] + 1 + covered[n - 1 :], odd[:-1] | long[n - 1 :]
                last = last[1:]
            wanted = (self.owner[last] == self.owner[last - n + 1]) & (last >= known)
            crc = runs ^ zeros(grams * (PLACES + 1))[total]
            for at in np.flatnonzero(odd & wanted).tolist():
                span = range(int(last[at]) - n + 1, int(last[at]) + 1)
                crc[at] = zlib.crc32(b" ".join(self.signs[self.starts[w] : self.ends[w]].tobytes() for w in span))
            yield last[wanted], crc[wanted]


def run_hashes(texts: list[bytes], grams: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(words of each text, text of each run, crc of each run)`` for some of the texts at a time; words and runs of a long
    text come in several parts."""
    waiting, size = [], 0
    for index, data in enumerate(texts):
        if len(data) > WINDOW:
            yield from _long(index, data, grams, len(texts))
            continue
        if size + len(data) > WINDOW:
            yield from _together(waiting, grams, len(texts))
            waiting, size = [], 0
        waiting.append((index, data))
        size += len(data) + 1
    yield from _together(waiting, grams, len(texts))


def _together(waiting: list[tuple[int, bytes]], grams: int, count: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    if not waiting:
        return
    sizes = np.array([len(data) + 1 for _, data in waiting])
    window = Window(b"\n".join(data for _, data in waiting), np.cumsum(sizes) - sizes)
    yield _found(window, np.array([index for index, _ in waiting]), grams, 0, count)


def _found(window: Window, names: np.ndarray, grams: int, known: int, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = list(window.hashes(grams, known))
    owners = names[window.owner]
    words = np.bincount(owners[known:], minlength=count)
    last = np.concatenate([x for x, _ in found]) if found else np.empty(0, dtype=np.int64)
    return words, owners[last], np.concatenate([x for _, x in found]) if found else np.empty(0, dtype=np.uint32)


def _long(index: int, data: bytes, grams: int, count: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Windows that end between words; each starts with the last words of the one before, whose runs are known."""
    at, known, end = 0, 0, 0
    while end < len(data):
        end = _gap(data, end + WINDOW)
        window = Window(data[at:end], np.array([0]))
        yield _found(window, np.array([index]), grams, known, count)
        known = min(grams - 1, len(window.starts))
        at = at + int(window.starts[-known]) if known else end


def _gap(data: bytes, at: int) -> int:
    """The first place from ``at`` where no word goes on."""
    signs = letters()
    while at < len(data) and signs[data[at]]:
        at += 1
    return min(at, len(data))
