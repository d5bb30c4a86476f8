"""NumPy kernels over Arrow batches of texts: packing, word hashes, n-gram hashes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex

PIECE_BYTES = 1 << 18  # texts are handled in pieces of about this size, so memory does not follow the batch
BASE = 0x9E3779B97F4A7C15  # odd, hence with an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
GRAM = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA24BAED4963EE407, 0x9FB21C651E98DF25],
                dtype=np.uint64)

SPACE, LETTER, NUMBER, OTHER = range(4)

_powers: dict[int, np.ndarray] = {}


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null becomes empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def pieces(sizes: list[int], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring rows with about `limit` bytes each; a longer row stands alone."""
    low, total = 0, 0
    for i, n in enumerate(sizes):
        if i > low and total + n > limit:
            yield low, i
            low, total = i, 0
        total += n
    if low < len(sizes):
        yield low, len(sizes)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for reuse up to twice a piece's length."""
    kept = _powers.get(base)
    if kept is not None and len(kept) >= n:
        return kept[:n]
    out = np.full(max(n, 1 << 16), base, dtype=np.uint64)
    out[0] = 1
    np.cumprod(out, out=out)
    if len(out) <= 2 * PIECE_BYTES:
        _powers[base] = out
    return out[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _word_sums(buffer: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, polynomial sum) of every word of one buffer."""
    data = np.frombuffer(buffer, dtype=np.uint8)
    inside = np.concatenate(([False], ~_SPACE[data], [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=sums[1:])
    back = powers(INVERSE, len(data))[start] if len(start) else np.zeros(0, np.uint64)
    return start, end, (sums[end] - sums[start]) * back


def text_words(text: bytes, lower: bool = False, size: int = PIECE_BYTES) -> Iterator[np.ndarray]:
    """Hashes of the words of one text in order, a piece of `size` bytes at a time. A word may span any number of pieces."""
    carried, length = 0, 0  # the part of a word that the pieces before ended in
    for at in range(0, len(text), size):
        part = text[at : at + size]
        start, end, sums = _word_sums(part.lower() if lower else part)
        if length and len(start) and start[0] == 0:
            sums[0] = np.uint64((carried + int(sums[0]) * pow(BASE, length, 1 << 64)) % (1 << 64))
            length += int(end[0])
        elif length:
            yield mix(np.array([carried], dtype=np.uint64))
            length = 0
        if len(end) and end[-1] == len(part):
            carried = int(sums[-1])
            length = length if len(end) == 1 and length else int(end[-1] - start[-1])
            sums = sums[:-1]
        else:
            length = 0
        yield mix(sums)
    if length:
        yield mix(np.array([carried], dtype=np.uint64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(document number, hash) of all words, in order. Words are runs of bytes other than ASCII white space.

    Besides the result, memory is bounded by the piece, however long a text or a word is.
    """
    docs, hashes = [], []
    for low, high in pieces([len(t) for t in texts], PIECE_BYTES):
        if high - low == 1 and len(texts[low]) > 2 * PIECE_BYTES:
            for h in text_words(texts[low], size=PIECE_BYTES):
                docs.append(np.full(len(h), low))
                hashes.append(h)
            continue
        group = texts[low:high]
        start, _, sums = _word_sums(b"\n".join(group))
        first = np.cumsum([0] + [len(t) + 1 for t in group[:-1]])
        docs.append(np.searchsorted(first, start, side="right") - 1 + low)
        hashes.append(mix(sums))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(docs), np.concatenate(hashes)


def gram_hashes(docs: np.ndarray, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document number, hash) of all runs of `n` words within a document."""
    if len(words) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    size = len(words) - n + 1
    h = np.full(size, n, dtype=np.uint64)
    for j in range(n):
        h += words[j : j + size] * GRAM[j]
    whole = docs[:size] == docs[n - 1 :]
    return docs[:size][whole], mix(h[whole])


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """The class of every code point: white space, letter, number or anything else."""
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for kind, members in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for run in regex.finditer(members, every):
            table[ord(run.group()[0]) : ord(run.group()[-1]) + 1] = kind
    return table


@lru_cache(maxsize=1)
def lower_points() -> np.ndarray:
    """The lower-case form of every code point that has a single one; others stand for themselves."""
    table = np.arange(0x110000, dtype=np.uint32)
    for i in np.flatnonzero(char_classes() == LETTER).tolist():
        small = chr(i).lower()
        if len(small) == 1:
            table[i] = ord(small)
    return table
