"""Words of many texts at once: byte spans, hashes and rolling hashes in numpy.

Texts stay one UTF-8 byte buffer, as Arrow hands them over; no Python string is made per word.
All helpers take a *piece*: some whole texts whose bytes lie end to end.  Pieces hold about
``PIECE`` bytes, so memory follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: bytes of text worked on at a time; a longer text is a piece of its own
PIECE = 1 << 18
#: odd multipliers of the two rolling hashes over words, and of the hash over bytes
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
BYTE_BASE = 0xA0761D6478BD642F
#: odd multipliers of the two hashes of words, and the bytes they take at a time
BYTE_KEYS = (0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)
SLICE = 1 << 18
MASK = (1 << 64) - 1

SPACES = b"\t\n\x0b\x0c\r "
#: bytes that are part of a word: everything but ASCII white space
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[list(SPACES)] = False
#: bytes that are part of a word: ASCII digits and letters, and every byte of other characters
ALNUM = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
#: A-Z to a-z, other bytes unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Piece:
    """Some texts of a batch: rows ``first`` to ``last``, their bytes and the start of each."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return self.last - self.first


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[Piece]:
    """Cut a text column into pieces; NULL is the empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:][:len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Piece(first, last, data[offsets[first]:offsets[last]],
                    offsets[first:last + 1] - offsets[first])
        first = last


def parts(piece: Piece, part_of_word: np.ndarray, limit: int = PIECE) -> Iterator[Piece]:
    """Cut a piece of one text into parts of about ``limit`` bytes, between words; a longer word
    stays whole."""
    low, size = 0, len(piece.data)
    while low < size:
        high = min(low + limit, size)
        gaps = np.flatnonzero(~part_of_word[piece.data[low:high]])
        if high < size and len(gaps):
            high = low + int(gaps[-1]) + 1
        elif high < size:
            while high < size and not len(gaps):
                gaps = np.flatnonzero(~part_of_word[piece.data[high:high + limit]])
                high = high + int(gaps[0]) + 1 if len(gaps) else min(high + limit, size)
        yield Piece(piece.first, piece.last, piece.data[low:high], np.array([0, high - low]))
        low = high


def spans(piece: Piece, part_of_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the text (counted in the piece) it stands in."""
    inside = part_of_word[piece.data]
    edges = piece.offsets[:-1][piece.offsets[:-1] < len(inside)]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    if len(inside):
        before[0] = after[-1] = False
    before[edges] = False
    after[edges[edges > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    texts = np.searchsorted(piece.offsets, starts, "right") - 1
    return starts, ends, texts


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over the whole word."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as long as they were needed."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, size, 1 << 64))])
            self.down = np.concatenate(
                [self.down, self.down * np.uint64(pow(self.inverse, size, 1 << 64))])
        return self.up[:n], self.down[:n]


_BYTES = Powers(BYTE_BASE)
_WORDS = tuple(Powers(base) for base in BASES)


def _prefix(values: np.ndarray, up: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    return total


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                heads: tuple[int, ...] = ()) -> np.ndarray:
    """64-bit hashes of each byte span, a row for whole spans and one for each size of beginnings
    in ``heads``; equal spans hash alike wherever they stand.  Spans follow one another.

    A sum of powers: good for buckets of features.  Long spans can be made to collide, so words that
    have to be told apart take :func:`word_hashes`.  Bytes are worked on ``SLICE`` at a time."""
    stops = np.stack([ends, *(np.minimum(starts + size, ends) for size in heads)])
    out = np.zeros(stops.shape, np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + SLICE, "right")))
        low, high = int(starts[first]), int(ends[last - 1])
        for at in range(low, high, SLICE):  # more than one step for a long span of its own only
            held = data[at:min(at + SLICE, high)]
            up, down = _BYTES.upto(len(held) + 1)
            prefix = _prefix(held.astype(np.uint64) + np.uint64(1), up)
            begin = np.clip(starts[first:last] - at, 0, len(held))
            end = np.clip(stops[:, first:last] - at, 0, len(held))
            ahead = np.uint64(pow(BYTE_BASE, at - low, 1 << 64))
            out[:, first:last] += (prefix[end] - prefix[begin]) * down[begin] * ahead
        first = last
    return mix(out + (stops - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                which: int = 0) -> np.ndarray:
    """64-bit hash of each word, the first or second of two independent ones.

    Every byte is mixed with its place in the word and with a key before the sums are taken, so that
    no arrangement of bytes cancels out.  Bytes are worked on ``SLICE`` at a time."""
    sizes = ends - starts
    out = np.zeros(len(starts), np.uint64)
    done = np.concatenate([[0], np.cumsum(sizes)])
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(done, done[first] + SLICE, "right")) - 1)
        size = sizes[first:last]
        if last == first + 1:
            for low in range(0, int(size[0]), SLICE):
                high = min(low + SLICE, int(size[0]))
                held = data[starts[first] + low:starts[first] + high]
                out[first:last] += _byte_values(held, np.arange(low, high), which).sum()
        else:
            heads = done[first:last] - done[first]
            place = np.arange(done[last] - done[first]) - np.repeat(heads, size)
            held = data[place + np.repeat(starts[first:last], size)]
            out[first:last] = np.add.reduceat(_byte_values(held, place, which), heads)
        first = last
    return mix(out + sizes.astype(np.uint64) * np.uint64(BASES[which]))


def _byte_values(data: np.ndarray, place: np.ndarray, which: int) -> np.ndarray:
    """A number for each byte at its place, as good as drawn at random."""
    spot = place.astype(np.uint64) << np.uint64(8) | data
    return mix((spot + np.uint64(1)) * np.uint64(BYTE_KEYS[which]))


def rolling(hashes: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """Rabin-Karp hash of every ``length`` consecutive words, by the first or second base; ``SLICE``
    windows at a time."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    if which:
        hashes = mix(hashes + np.uint64(BASES[1]))
    out = np.empty(count, np.uint64)
    for low in range(0, count, SLICE):  # a window's hash does not depend on its place
        high = min(low + SLICE, count)
        held = hashes[low:high + length - 1]
        up, down = _WORDS[which].upto(len(held) + 1)
        total = _prefix(held, up)
        out[low:high] = (total[length:] - total[:-length]) * down[:high - low]
    return mix(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        done += step
    return out


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the signed ones Spark holds."""
    return values.view(np.int64)
