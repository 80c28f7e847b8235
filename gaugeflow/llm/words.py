"""Words, word codes and shingle codes of a batch of texts (numpy).

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]`` of the UTF-8 text
with A-Z lower-cased. Words become 64-bit codes (a polynomial over random byte
values, then a finaliser); a shingle's code mixes the codes of its words.
Texts are worked through in chunks of whole texts, so memory follows the
chunk size or the longest single text, whichever is larger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 18
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = (int(_RNG.integers(1, 1 << 61)) * 8 + 5) % (1 << 64)
_STEP_INV = pow(_STEP, -1, 1 << 64)
_LANE = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept between batches."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(max(n, CHUNK_BYTES * 2), np.uint64)
        have[1:] = _U(base)
        _powers[base] = have = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (every input bit reaches every output bit)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(codes of all words in order, number of words of each text)."""
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    joined = b" ".join(texts).lower() + b" "
    buf = np.frombuffer(joined, np.uint8)
    space = _SPACE[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    run = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * _power(_STEP, len(buf)), dtype=np.uint64, out=run[1:])
    codes = mix((run[end] - run[start]) * _power(_STEP_INV, len(buf))[start])
    stops = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(start, stops, "left")
    return codes, np.diff(np.concatenate(([0], upto)))


def shingle_codes(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes of all ``width``-word shingles in order, number of each text).
    A text of fewer words has its whole sequence as one shingle; one without
    words has none."""
    codes, counts = word_codes(texts)
    starts = np.concatenate(([0], np.cumsum(counts)))
    n = len(codes)
    out = np.zeros(0, np.uint64)
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    if n >= width:
        acc = codes[: n - width + 1] * _LANE[0]
        for k in range(1, width):
            acc = acc + codes[k : n - width + 1 + k] * _LANE[k]
        acc = mix(acc + _U(width))
    else:
        acc = np.zeros(0, np.uint64)
    # Positions of valid starts: those whose window ends inside the text.
    text_of = np.repeat(np.arange(len(counts)), made)
    first = np.cumsum(made) - made
    where = starts[:-1][text_of] + (np.arange(len(text_of)) - first[text_of])
    out = np.zeros(len(text_of), np.uint64)
    long = counts[text_of] >= width
    out[long] = acc[where[long]]
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        own = codes[starts[i] : starts[i + 1]]
        out[first[i]] = mix((own * _LANE[: len(own)]).sum(dtype=np.uint64, keepdims=True) + _U(len(own)))[0]
    return out, made


def chunks(texts: list, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Whole texts in runs of about ``limit`` bytes: (first index, texts)."""
    at, own, size = 0, [], 0
    for i, t in enumerate(texts):
        b = b"" if t is None else t.encode("utf-8", "surrogatepass") if isinstance(t, str) else t
        own.append(b)
        size += len(b)
        if size >= limit:
            yield at, own
            at, own, size = i + 1, [], 0
    if own:
        yield at, own


def shingle_sets(texts: list, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle codes of each text, in order."""
    for _, part in chunks(texts):
        codes, made = shingle_codes(part, width)
        stops = np.cumsum(made)
        for a, b in zip(stops - made, stops):
            yield np.unique(codes[a:b])
