"""Words, n-grams and their hashes, vectorised with numpy over a batch of texts.

A batch is one byte array: A-Z lowered, bytes that belong to no word turned to spaces. Words
are hashed by a polynomial over prefix sums modulo 2**64, so no Python object per word is made.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np

# Fixed by the contract: a word is a run of [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing A-Z.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORDS_ONLY = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in LOWER
)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
# Text worked on at once; arrays of eight bytes for each of text, and several of them, are live.
BATCH_BYTES = 512 << 10

_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and ``BASE**-i`` modulo 2**64 for ``i < n``."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, BATCH_BYTES * 3 // 2)
        up, down = (np.full(size, x, np.uint64) for x in (BASE, INVERSE))
        up[0] = down[0] = 1
        _powers = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return _powers


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def slices(texts: Sequence[str | None], most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes of text; a longer text is alone in its range."""
    start = size = 0
    for i, t in enumerate(texts):
        n = 4 if t is None else len(t) + 4
        if i > start and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def batch_bytes(texts: Iterable[str | None], keep: bytes = WORDS_ONLY) -> tuple[np.ndarray, np.ndarray]:
    """One byte array of all texts, each followed by a space, and where each text starts."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
    joined = b" ".join([*parts, b""]).translate(keep)
    return np.frombuffer(joined, np.uint8), starts


def word_hashes(
    texts: Sequence[str | None], prefix: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, or of their first ``prefix`` bytes, and the number of
    the first word of each text (one more entry at the end). Memory beyond the result is
    bounded by the longest text."""
    parts = [_word_hashes(texts[a:b], prefix) for a, b in slices(texts)]
    first = np.zeros(len(texts) + 1, np.int64)
    if not parts:
        return np.zeros(0, np.uint64), first
    np.cumsum(np.concatenate([np.diff(f) for _, f in parts]), out=first[1:])
    return np.concatenate([h for h, _ in parts]), first


def _word_hashes(
    texts: Sequence[str | None], prefix: int | None
) -> tuple[np.ndarray, np.ndarray]:
    data, starts = batch_bytes(texts)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = data != 32
    steps = np.diff(inside)
    begin, end = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64, out=sums[1:])
    if prefix is not None:
        end = np.minimum(end, begin + prefix)
    hashes = mix64((sums[end] - sums[begin]) * down[begin])
    return hashes, np.searchsorted(begin, starts)


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words within a text, and the text of each. A text of
    fewer words, but not none, has one run of all of them."""
    n = np.diff(first)
    runs = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), runs)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    start, length = first[:-1][owner] + offset, np.minimum(n, width)[owner]
    out = np.full(len(owner), 0x51ED27, np.uint64)
    for k in range(width):
        live = k < length
        word = hashes[np.minimum(start + k, max(0, len(hashes) - 1))] if len(hashes) else out
        out = np.where(live, mix64(out * BASE + word), out)
    return out, owner


def code_points(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, with a space before and after each; where each starts."""
    parts = [f" {t} " if t else "  " for t in texts]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=starts[1:])
    joined = "".join(parts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, np.uint32), starts


def ngrams(points: np.ndarray, starts: np.ndarray, sizes: Sequence[int], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of n-grams hashed to ``bits`` bits: text, feature and count, by text."""
    n = len(starts) - 1
    owner = np.repeat(np.arange(n), np.diff(starts)).astype(np.uint64) << np.uint64(bits)
    keys, x = [], points.astype(np.uint64)
    gram = np.zeros(len(x), np.uint64)
    for size in range(1, max(sizes) + 1):
        if len(x) < size:
            break
        gram = gram[: len(x) - size + 1] * BASE + x[size - 1 :]
        if size in sizes:
            inside = owner[: len(gram)] == owner[size - 1 :]
            feature = mix64(gram + np.uint64(size)) >> np.uint64(64 - bits)
            keys.append((owner[: len(gram)] | feature)[inside])
    return counted(np.concatenate(keys) if keys else np.zeros(0, np.uint64), bits)


def counted(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, feature and count from keys of text and feature, the latter of ``bits`` bits."""
    keys = np.sort(keys)
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    count = np.diff(np.r_[at, len(keys)])
    keys = keys[at]
    return (
        (keys >> np.uint64(bits)).astype(np.int64),
        (keys & np.uint64((1 << bits) - 1)).astype(np.int64),
        count,
    )
