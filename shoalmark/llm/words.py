"""Words of many texts as 64-bit hashes, without a Python object for each word.

A word's hash is the sum, modulo 2**64, of a pseudo-random number for each of its bytes and the place
of that byte in the word, mixed afterwards. No family of words has equal hashes by construction, as
polynomials modulo 2**64 have; two given words meet with a probability of about 2**-64. Texts are
hashed in pieces of about a megabyte, cut between words, so that the working memory does not grow
with the length of a text.
"""

from __future__ import annotations

import numpy as np

_STEP = 1 << 20
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: A-Z in lower case, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table that is true for the bytes in the given inclusive ranges."""
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a : b + 1] = True
    return table


#: Everything but blank and the control characters from tab to carriage return.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Digits, letters and everything beyond ASCII.
ALPHANUMERIC = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for at, base in ((0, _BASE), (1, _INVERSE)):
            table = np.full(n, np.uint64(base))
            table[0] = 1
            _powers[at] = np.cumprod(table, dtype=np.uint64)
    return _powers[0], _powers[1]


def _random(place: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """A pseudo-random number for each place in a word and byte there."""
    return mix(mix((place.astype(np.uint64) << np.uint64(8)) | byte) + np.uint64(_BASE))


#: The numbers of the first places, which most words do not go beyond.
_FIRST = 32
_NUMBERS = _random(np.arange(_FIRST << 8) >> 8, np.arange(_FIRST << 8, dtype=np.uint64) & np.uint64(255))


def _hash_piece(data: np.ndarray, word: np.ndarray) -> np.ndarray:
    inside = word[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    lengths = edges[1::2] - edges[::2]
    if not len(lengths):
        return np.zeros(0, np.uint64)
    stops = np.cumsum(lengths)
    letters = LOWER[data[inside]]
    place = np.arange(stops[-1]) - np.repeat(stops - lengths, lengths)
    numbers = _NUMBERS[(np.minimum(place, _FIRST - 1) << 8) | letters]
    if lengths.max() > _FIRST:
        far = np.flatnonzero(place >= _FIRST)
        numbers[far] = _random(place[far], letters[far].astype(np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(numbers, dtype=np.uint64)])
    return mix(sums[stops] - sums[stops - lengths])


def word_hashes(texts: list[str], word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text."""
    counts = np.zeros(len(texts), np.int64)
    found: list[np.ndarray] = []
    pending: list[bytes] = []
    first, held = 0, 0

    def flush(upto: int) -> None:
        nonlocal pending, first, held
        if pending:
            data = np.frombuffer(b"\n".join(pending), np.uint8)
            begin = np.concatenate([[True], ~word[data[:-1]]]) & word[data] if len(data) else data
            lengths = np.array([len(p) + 1 for p in pending])
            which = np.repeat(np.arange(len(pending)), lengths)[: len(data)]
            counts[first:upto] = np.bincount(which[begin], minlength=len(pending))
            found.append(_hash_piece(data, word))
        pending, first, held = [], upto, 0

    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass")
        if len(data) > _STEP:
            flush(i)
            for piece in _cut(np.frombuffer(data, np.uint8), word):
                hashes = _hash_piece(piece, word)
                counts[i] += len(hashes)
                found.append(hashes)
            first = i + 1
            continue
        if held + len(data) > _STEP:
            flush(i)
        pending.append(data)
        held += len(data) + 1
    flush(len(texts))
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), counts


def _cut(data: np.ndarray, word: np.ndarray):
    """Pieces of about a megabyte that end between words."""
    start = 0
    while start < len(data):
        end = min(len(data), start + _STEP)
        while end < len(data) and word[data[end]]:
            end += 1
        yield data[start:end]
        start = end
