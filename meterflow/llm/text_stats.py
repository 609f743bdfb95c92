"""Statistics of whole texts, the inputs of the quality and toxicity scores."""

from __future__ import annotations

import numpy as np

from meterflow.llm.kernel import BLOCK, U64, mix, text_buffers, word_hashes


def _is(*ranges) -> np.ndarray:
    t = np.zeros(256, bool)
    for r in ranges:
        if isinstance(r, str):
            t[[ord(c) for c in r]] = True
        else:
            t[r[0]: r[1] + 1] = True
    return t


CLASSES = {
    "upper": _is((65, 90)), "lower": _is((97, 122)), "digit": _is((48, 57)), "space": _is(" \t\r\f\v"), "line": _is("\n"),
    "shout": _is("!"), "bar": _is("|"), "symbol": _is("#$%&*^~@=+<>_\\/`{}[]"), "stop": _is(".,;:?'\"()-"), "wide": _is((192, 255)),
}


def byte_counts(data: np.ndarray, off: np.ndarray, classes: dict[str, np.ndarray] = CLASSES) -> dict[str, np.ndarray]:
    """How many bytes of each class every text has; three 21-bit counters share a word."""
    n, names = len(off) - 1, list(classes)
    out = {c: np.zeros(n, np.int64) for c in names}
    for g in range(0, len(names), 3):
        three = names[g: g + 3]
        lut = sum(classes[c].astype(U64) << U64(21 * i) for i, c in enumerate(three))
        for lo in range(0, len(data), BLOCK):
            hi = min(lo + BLOCK, len(data))
            a = int(np.searchsorted(off, lo, side="right") - 1)
            b = int(np.searchsorted(off, hi))
            cut = np.maximum(off[a:b], lo)
            some = np.minimum(off[a + 1: b + 1], hi) > cut
            sums = np.add.reduceat(lut[data[lo:hi]], cut[some] - lo) if some.any() else np.empty(0, U64)
            for i, c in enumerate(three):
                out[c][np.arange(a, b)[some]] += ((sums >> U64(21 * i)) & U64(0x1FFFFF)).astype(np.int64)
    return out


def per_text(values: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sums of word-wise values over each text (``w``: word offsets)."""
    c = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return c[w[1:]] - c[w[:-1]]


def share(x, n) -> np.ndarray:
    return np.asarray(x, np.float64) / np.maximum(n, 1)


QUALITY = ["log_words", "word_size", "upper", "digit", "shouts", "bars", "symbols", "stops", "spaces", "lines",
           "distinct_words", "distinct_pairs", "repeats", "top_word", "wide"]


def quality_stats(col) -> dict[str, np.ndarray]:
    """The columns QUALITY for an Arrow string column; null and empty texts have 0 everywhere."""
    data, off = text_buffers(col)
    size = np.diff(off)
    c = byte_counts(data, off)
    h, w = word_hashes(data, off)
    n = np.diff(w)
    again = np.zeros(len(h), bool)
    again[1:] = h[1:] == h[:-1]
    again[w[:-1][n > 0]] = False
    pair = mix(h[:-1] * U64(0x2545F4914F6CDD1D) + h[1:]) if len(h) > 1 else np.empty(0, U64)
    words, pairs, top = np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n))
    for i, (a, b) in enumerate(zip(w[:-1].tolist(), w[1:].tolist())):
        if b > a:
            s = np.sort(h[a:b])
            first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
            words[i], top[i] = len(first), np.diff(np.append(first, b - a)).max()
            if b > a + 1:
                p = np.sort(pair[a: b - 1])
                pairs[i] = 1 + np.count_nonzero(p[1:] != p[:-1])
    letters = c["upper"] + c["lower"]
    return {
        "log_words": np.log1p(n), "word_size": share(size - c["space"] - c["line"], n), "upper": share(c["upper"], letters),
        "digit": share(c["digit"], size), "shouts": share(c["shout"], n), "bars": share(c["bar"], n), "symbols": share(c["symbol"], n),
        "stops": share(c["stop"], n), "spaces": share(c["space"], size), "lines": share(c["line"], n),
        "distinct_words": share(words, n), "distinct_pairs": share(pairs, n - 1), "repeats": share(per_text(again, w), n),
        "top_word": share(top, n), "wide": share(c["wide"], size),
    }
