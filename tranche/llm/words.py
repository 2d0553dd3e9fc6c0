"""Words and their hashes from Arrow text columns, many documents at a time in numpy.

Texts are cut at byte level: every separator named here is ASCII, and in UTF-8 no byte of a longer
character is. Documents are handled in pieces of about a quarter megabyte, so memory follows the longest
text, not the batch.

Hashes of spans are polynomials modulo two primes with fixed random bases, 62 bits together: two
different spans of n items have one hash for at most n of 2 ** 31 bases of each prime. (Modulo
2 ** 64 there are texts that agree for every base.)
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 18
#: After so many bytes of text a worker gives freed memory back, since it lives on in later stages.
RELEASE_BYTES = 1 << 24
#: What a worker remembers for one operator it drops after so many bytes of text handled by others.
IDLE_BYTES = 1 << 22
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Primes below 2 ** 31 and the base used with each.
MODULI = ((2147483629, 1382400769), (2147483587, 907633385))
#: Below so many bytes, sums of byte times power stay below 2 ** 64 without reduction.
UNREDUCED = 1 << 23
#: Tables of powers up to this size are kept; a longer text makes its own. LOW: rows of the lower table.
KEPT = 1 << 20
LOW = 1 << 10

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
_handled = 0
_powers: dict[tuple[int, int], np.ndarray] = {}
#: For each memory in use, what empties it, and the bytes handled since its last use.
_memories: dict[Callable[[], None], int] = {}


def separators(keep: str | None = None) -> np.ndarray:
    """For each byte, whether it separates words: space and \\t to \\r, or with ``keep="letters"``
    every ASCII character that is neither a lower-case letter nor a digit."""
    code = np.arange(256)
    if keep == "letters":
        word = (code >= 128) | ((code >= 48) & (code <= 57)) | ((code >= 97) & (code <= 122))
        return ~word
    return (code == 32) | ((code >= 9) & (code <= 13))


SPACES = separators()
NOT_LETTERS = separators("letters")


@dataclass
class Piece:
    """Some consecutive documents of a batch. ``data``: their bytes with A-Z lowered; ``starts``:
    where each document begins in them, and the end."""

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray


def in_use(empty: Callable[[], None]) -> None:
    """Note that a memory is in use now; ``empty`` is called once others have handled IDLE_BYTES since."""
    _memories[empty] = 0


def released(handled: int) -> None:
    """Count handled bytes, drop memories that lie idle, and give freed memory back to the system from time to time."""
    global _handled
    _handled += handled
    idle = []
    for empty in _memories:
        _memories[empty] += handled
        if _memories[empty] >= IDLE_BYTES:
            idle.append(empty)
    for empty in idle:
        del _memories[empty]
        empty()
    if _handled >= RELEASE_BYTES or idle:
        _handled = 0
        pa.default_memory_pool().release_unused()
        if _trim is not None:
            _trim(0)


def pieces(texts: pa.Array, limit: int = PIECE_BYTES, lower: bool = True) -> Iterator[Piece]:
    """Cut a text column (null: empty) into pieces of about ``limit`` bytes; a longer text is one piece."""
    texts = texts.fill_null("").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(texts))
        part = data[offsets[first]:offsets[last]].copy()
        if lower:
            part[(part >= 65) & (part <= 90)] += 32
        size = len(part)
        yield Piece(first, last, part, offsets[first:last + 1] - offsets[first])
        del part
        released(size)
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, prime: int, exponents: np.ndarray) -> np.ndarray:
    """Powers of ``base`` modulo ``prime``, from two tables of LOW and as many rows as the largest needs."""
    modulus = np.uint64(prime)
    low = _table(base, prime, LOW)
    high = _table(pow(base, LOW, prime), prime, int(exponents.max(initial=0)) // LOW + 1)
    return low[exponents % LOW].astype(np.uint64) * high[exponents // LOW] % modulus


def _table(base: int, prime: int, size: int) -> np.ndarray:
    """The powers of ``base`` modulo ``prime`` from 0 to at least ``size`` - 1, doubled as needed."""
    known = _powers.get((base, prime), np.ones(1, np.uint32))
    while len(known) < size:
        step = np.uint64(pow(base, len(known), prime))
        known = np.concatenate((known, (known * step % np.uint64(prime)).astype(np.uint32)))
    if size <= KEPT:
        _powers[base, prime] = known
    return known


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span of bytes (or numbers), from running sums of two polynomials."""
    small = data.dtype.itemsize == 1 and len(data) < UNREDUCED
    parts = []
    for prime, base in MODULI:
        modulus = np.uint64(prime)
        terms = data.astype(np.uint64) if small else data.astype(np.uint64) % modulus
        terms += np.uint64(1)
        terms *= _table(base, prime, len(data) + 1)[:len(data)]
        if not small:
            terms %= modulus
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        del terms
        shift = _power(pow(base, -1, prime), prime, np.asarray(begin, np.int64))
        parts.append((sums[end] - sums[begin]) % modulus * shift % modulus)
    return mixed(((parts[0] << np.uint64(31)) | parts[1]) + (end - begin).astype(np.uint64) * BASE)


@dataclass
class Words:
    """Words of a piece in order: document (index in the piece), byte span, hash, and where each
    document's words begin."""

    doc: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    starts: np.ndarray


def words(piece: Piece, separator: np.ndarray) -> Words:
    count = len(piece.starts) - 1
    inside = ~separator[piece.data]
    edge = np.zeros(len(piece.data) + 1, bool)  # a document's first byte never continues a word
    edge[piece.starts] = True
    before = np.concatenate(([False], inside))
    after = np.concatenate((inside, [False]))
    begin = np.flatnonzero(after & (~before | edge))
    end = np.flatnonzero(before & (~after | edge))
    doc = np.searchsorted(piece.starts, begin, "right") - 1
    hashes = span_hashes(piece.data, begin, end)
    starts = np.searchsorted(doc, np.arange(count + 1))
    return Words(doc, begin, end, hashes, starts)


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``size`` consecutive words, as (document, hash) sorted by both; a document
    of fewer words has its whole sequence as one, a document without words none."""
    count = len(found.starts) - 1
    lengths = np.diff(found.starts)
    total = len(found.hash)
    rolled = np.zeros(max(total - size + 1, 0), np.uint64)
    for k in range(size):
        rolled += found.hash[k:k + len(rolled)] * np.uint64(2 * (k + 1) * 0x632BE59BD9B4E019 + 1 & 0xFFFFFFFFFFFFFFFF)
    at = np.arange(len(rolled))
    doc = found.doc[:len(rolled)]
    whole = at + size <= found.starts[doc + 1] if len(rolled) else np.zeros(0, bool)
    docs, hashes = [doc[whole]], [mixed(rolled[whole])]
    for short in np.flatnonzero((lengths > 0) & (lengths < size)):
        own = found.hash[found.starts[short]:found.starts[short + 1]]
        value = np.uint64(len(own))
        for word in own:
            value = mixed(np.array([value]) * BASE + word)[0]
        docs.append(np.array([short]))
        hashes.append(np.array([value], np.uint64))
    doc, value = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[first], value[first]
