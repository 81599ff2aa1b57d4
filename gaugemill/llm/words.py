"""Words of many texts at once, as hashes, with numpy over the texts' UTF-8 bytes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Texts are worked on in slices of about this many bytes, whatever the size of a batch.
SLICE_BYTES = 4 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_KEY = np.uint64(0x5851F42D4C957F2D)

# A-Z as a-z; and the first 0 to 8 bytes of a block of eight.
_LOWER = np.array([x + 32 if 0x41 <= x < 0x5B else x for x in range(256)], np.uint8)
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

LONG = 256  # bytes; longer words are taken one by one


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def blocks_of(data: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at each place, as one number, A-Z as a-z; zeros follow the end."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = _LOWER[data]
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def hashes_of(blocks: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges; they don't depend on where a range stands.

    Eight bytes at a time are mixed in, so that what stands where always matters.
    """
    lengths = ends - starts
    result = mix(lengths.astype(np.uint64) + _KEY)
    for step in range(0, int(min(lengths.max(initial=0), LONG)), 8):
        which = np.flatnonzero((lengths > step) & (lengths <= LONG)) if step else slice(None)
        held = blocks[starts[which] + step] & _FIRST[np.minimum(lengths[which] - step, 8)]
        result[which] = mix((result[which] ^ held) * _ODD)
    for at in np.flatnonzero(lengths > LONG).tolist():
        digest = hashlib.blake2b(_bytes(blocks, starts[at], ends[at]), digest_size=8).digest()
        result[at] = int.from_bytes(digest, "little")
    return result


def same_words(
    left: np.ndarray, at: np.ndarray, right: np.ndarray, beside: np.ndarray, lengths: np.ndarray
) -> np.ndarray:
    """Whether so many bytes from each place of ``left`` equal those of ``right``, as blocks."""
    same = np.ones(len(at), bool)
    for step in range(0, int(min(lengths.max(initial=0), LONG)), 8):
        which = np.flatnonzero(same & (lengths > step) & (lengths <= LONG))
        differ = left[at[which] + step] ^ right[beside[which] + step]
        same[which] = differ & _FIRST[np.minimum(lengths[which] - step, 8)] == 0
    for one in np.flatnonzero(lengths > LONG).tolist():
        a, b, size = int(at[one]), int(beside[one]), int(lengths[one])
        same[one] = _bytes(left, a, a + size) == _bytes(right, b, b + size)
    return same


def _bytes(blocks: np.ndarray, start: int, end: int) -> bytes:
    return np.ndarray(end - start, np.uint8, blocks.base, offset=int(start)).tobytes()


class Alphabet:
    """Which bytes belong to words; A-Z count as a-z."""

    def __init__(self, pattern: bytes) -> None:
        self.in_word = np.array([re.fullmatch(pattern, bytes([x])) is not None for x in range(256)])

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return hashes_of(blocks_of(data), starts, ends)


LETTERS_AND_DIGITS = Alphabet(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]|[A-Z]")
NO_SPACE = Alphabet(rb"[^\x20\x09-\x0D]")


@dataclass(frozen=True)
class Words:
    """The words of some texts: hashes, byte ranges, and where each text's words begin."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # one more than there are texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def spans_of(
    data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet
) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end, of texts whose bytes lie one after the other in ``data``."""
    inside = alphabet.in_word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]  # nothing stands between texts
    begins[edges] = inside[edges]
    stops[edges - 1] = inside[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased."""
    starts, ends = spans_of(data, offsets, LETTERS_AND_DIGITS)
    hashes = LETTERS_AND_DIGITS.hashes(data, starts, ends)
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


def windows_of(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of so many words within a text, and the text of each.

    A text of fewer words, but not none, is one window.
    """
    hashes, text = words.hashes, words.text_of()
    counts, total = words.counts, len(words.hashes)
    widths = np.minimum(counts, width)[text]
    fits = np.arange(total) + widths <= words.first[1:][text]
    fits &= (widths == width) | (np.arange(total) == words.first[:-1][text])
    at = np.flatnonzero(fits)
    values, sizes = np.zeros(len(at), np.uint64), widths[at]
    for step in range(width):
        used = sizes > step
        values[used] = mix(values[used] * _ODD + hashes[at[used] + step])
    return values, text[at]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes and offsets; NULL counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    begins = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    whole = np.frombuffer(data, np.uint8)
    return whole[begins[0] : begins[-1]], begins - begins[0]


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """A string column in runs of rows of limited size: first row, end, bytes, offsets."""
    data, offsets = utf8(column)
    row, rows = 0, len(column)
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end
