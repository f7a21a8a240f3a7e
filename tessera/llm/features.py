"""Text statistics and hashed n-gram features, shared by the two quality models.

Everything works on one UTF-8 text at a time with numpy: memory follows the
text, and the feature vector has a fixed width.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np

BUCKETS = 2048                       # per family: character 3-grams, 5-grams, words, word pairs
FAMILIES = 4
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_BLANK = np.zeros(256, dtype=bool)
_BLANK[list(b" \t\n\r\x0b\x0c")] = True
_CONTINUES = np.zeros(256, dtype=bool)
_CONTINUES[0x80:0xC0] = True
_CHAR = np.where(_BLANK | _CONTINUES, 0, 1).astype(np.uint8)

DENSE = ("repeat_share", "dup_line_share", "symbol_share", "upper_share", "distinct_share",
         "word_chars_mean", "digit_share", "log_words")


class Basics(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def word_ids(words: list[bytes]) -> np.ndarray:
    """Words numbered by first occurrence within the text."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))


def repeat_words(ids: np.ndarray) -> int:
    """Words covered by 3-word windows that occur twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    base = int(ids.max()) + 1
    pair = ids[:-1] * base + ids[1:]
    if base > 2_000_000:             # base ** 3 would not fit: number the pairs first
        pair = np.unique(pair, return_inverse=True)[1]
    _, at, times = np.unique(pair[:-1] * base + ids[2:], return_inverse=True, return_counts=True)
    twice = times[at] > 1
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[k:n - 2 + k] |= twice
    return int(covered.sum())


def basics(text: bytes, words: list[bytes], ids: np.ndarray) -> Basics:
    raw = np.frombuffer(text, dtype=np.uint8)
    seen, dup = set(), 0
    for line in text.split(b"\n"):
        if line.strip(b" \t\r\x0b\x0c"):
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    return Basics(len(words), int(_CHAR[raw].sum(dtype=np.int64)), int(_SYMBOLS[raw].sum()), dup, repeat_words(ids))


def dense(text: bytes, b: Basics, ids: np.ndarray) -> np.ndarray:
    """Bounded shares; zeros for a text without words."""
    if not b.n_words:
        return np.zeros(len(DENSE), dtype=np.float32)
    raw = np.frombuffer(text, dtype=np.uint8)
    chars = max(1, b.word_chars)
    upper = int(((raw >= 65) & (raw <= 90)).sum())
    digits = int(((raw >= 48) & (raw <= 57)).sum())
    lines = text.count(b"\n") + 1
    distinct = (int(ids.max()) + 1) / np.sqrt(b.n_words)
    return np.array([b.n_repeat_words / b.n_words, b.n_dup_lines / lines, min(1.0, 5 * b.n_symbols / chars),
                     upper / chars, min(2.0, distinct / 5), min(2.0, chars / b.n_words / 10),
                     digits / chars, np.log1p(b.n_words) / 10], dtype=np.float32)


def hashed(text: bytes, words: list[bytes]) -> np.ndarray:
    """Hashed character 3- and 5-grams, words and word pairs: square roots of
    shares per family, so texts of any length compare. A pair of equal words is
    one feature, whatever the word."""
    out = np.zeros((FAMILIES, BUCKETS), dtype=np.float32)
    raw = np.frombuffer(text, dtype=np.uint8).astype(np.uint64)
    for f, n in ((0, 3), (1, 5)):
        if len(raw) >= n:
            gram = np.zeros(len(raw) - n + 1, dtype=np.uint64)
            for k in range(n):
                gram = (gram << np.uint64(8)) | raw[k:len(raw) - n + 1 + k]
            out[f] = np.bincount((_mix(gram) % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
    if words:
        h = np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))
        out[2] = np.bincount((_mix(h) % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        if len(words) > 1:
            pair = _mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
            pair = np.where(h[:-1] == h[1:], np.uint64(0), pair)
            out[3] = np.bincount((pair % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
    out /= np.maximum(1, out.sum(axis=1, keepdims=True))
    return np.sqrt(out).ravel()


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def descend(gradient, width: int, steps: int, rate: float) -> np.ndarray:
    """Adam from zero on a full batch; deterministic."""
    w, m, v = (np.zeros(width) for _ in range(3))
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def calibrate(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt scaling: slope and intercept of P(1 | raw score), with the usual
    smoothed targets so that separable rows don't send them to infinity."""
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = max(1e-6, float(np.std(raw))) if len(raw) else 1.0
    x = np.stack([raw / scale, np.ones(len(raw))], axis=1)
    w = descend(lambda w: x.T @ (sigmoid(x @ w) - t) / max(1, len(y)), 2, 1500, 0.05)
    return float(max(w[0], 1e-3) / scale), float(w[1])
