"""Vectorised text kernels over Arrow buffers, used inside Python tasks.

Every function works on the raw UTF-8 buffer of a whole Arrow batch, in blocks
of bounded size, so memory follows the batch and not the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes worked on at once; a longer word extends its block.
BLOCK = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 5
_POW: dict[int, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    size = max(BLOCK * 2, 1 << int(n).bit_length())
    if size not in _POW:
        inv = pow(_BASE, -1, 1 << 64)
        out = []
        for b in (_BASE, inv):
            p = np.full(size, b, dtype=U64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=U64))
        _POW.clear()
        _POW[size] = tuple(out)
    return _POW[size]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on an array of 64-bit values."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h = h * U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def _byte_codes(lower: bool) -> np.ndarray:
    t = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
    if lower:
        t[65:91] = t[97:123]
    return t


CODES_LOWER = _byte_codes(True)
#: Word bytes of the shingle operators: everything but space and 0x09-0x0D.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False


def text_buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n+1 offsets of a string or binary column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], dtype=kind)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def pieces(batch, column: str = "text", limit: int = 1 << 20):
    """Slices of a record batch whose texts hold about ``limit`` bytes, one row at least."""
    _, off = text_buffers(batch.column(column))
    lo, n = 0, len(batch)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def word_spans(data: np.ndarray, off: np.ndarray, is_word: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data[lo:hi]``; texts never share a word."""
    m = is_word[data[lo:hi]]
    edge = np.zeros(hi - lo + 1, dtype=bool)
    a, b = np.searchsorted(off, [lo, hi])
    cut = off[a:b + 1]
    edge[cut[(cut >= lo) & (cut <= hi)] - lo] = True
    prev = np.empty_like(m)
    prev[0] = False
    prev[1:] = m[:-1]
    prev &= ~edge[:-1]
    nxt = np.empty_like(m)
    nxt[-1] = False
    nxt[:-1] = m[1:]
    nxt &= ~edge[1:]
    return np.flatnonzero(m & ~prev), np.flatnonzero(m & ~nxt) + 1


def _blocks(data: np.ndarray, off: np.ndarray, is_word: np.ndarray):
    """Ranges of about BLOCK bytes that end where a word ends."""
    lo, n = 0, len(data)
    while lo < n:
        hi = min(lo + BLOCK, n)
        while hi < n and is_word[data[hi]] and is_word[data[hi - 1]]:
            step = data[hi: hi + BLOCK]
            gap = np.flatnonzero(~is_word[step])
            stop = off[min(np.searchsorted(off, hi), len(off) - 1)]  # a text's end also ends a word
            to = hi + (gap[0] if len(gap) else len(step))
            hi = int(min(max(stop, hi), to)) if stop >= hi else int(to)
            if stop == hi or len(gap):
                break
        yield lo, hi
        lo = hi


def word_hashes(data, off, is_word=NOT_SPACE, codes=CODES_LOWER) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and n+1 word offsets of the texts."""
    hashes, starts = [], []
    for lo, hi in _blocks(data, off, is_word):
        s, e = word_spans(data, off, is_word, lo, hi)
        p, q = _powers(hi - lo + 1)
        c = np.zeros(hi - lo + 1, dtype=U64)
        np.cumsum(codes[data[lo:hi]] * p[: hi - lo], dtype=U64, out=c[1:])
        h = (c[e] - c[s]) * q[s]
        hashes.append(mix(h + (e - s).astype(U64) * U64(0xA0761D6478BD642F)))
        starts.append(s + lo)
    h = np.concatenate(hashes) if hashes else np.empty(0, U64)
    st = np.concatenate(starts) if starts else np.empty(0, np.int64)
    return h, np.searchsorted(st, off)


def word_counts(data, off, is_word=NOT_SPACE) -> np.ndarray:
    """Number of words of each text."""
    n = np.zeros(len(off) - 1, np.int64)
    for lo, hi in _blocks(data, off, is_word):
        s, _ = word_spans(data, off, is_word, lo, hi)
        text, count = np.unique(np.searchsorted(off, s + lo, side="right") - 1, return_counts=True)
        n[text] += count
    return n


def shingle_sets(data, off, width: int):
    """Yield, for each text, the sorted distinct hashes of its word shingles.

    A text with fewer words than ``width`` has its whole sequence as the one
    shingle; a text without words has none.
    """
    h, w = word_hashes(data, off)
    n = max(0, len(h) - width + 1)
    g = np.zeros(n, dtype=U64)
    for i in range(width):
        g = mix(g * U64(0x2545F4914F6CDD1D) + h[i: i + n])
    for a, b in zip(w[:-1].tolist(), w[1:].tolist()):
        if b - a >= width:
            s = np.sort(g[a: b - width + 1])
            yield s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif b > a:
            v = np.full(1, b - a, dtype=U64)
            for x in h[a:b]:
                v = mix(v * U64(0x9FB21C651E98DF25) + x)
            yield v
        else:
            yield np.empty(0, U64)


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours."""
    n = len(v) - w + 1
    pad = -len(v) % w
    x = np.concatenate((v, np.full(pad, ~U64(0)))).reshape(-1, w)
    left = np.minimum.accumulate(x, axis=1).ravel()
    right = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1: w - 1 + n])


CODES = _byte_codes(False)


def anchored_segments(data: np.ndarray, off: np.ndarray, length: int, k: int):
    """Runs of neighbouring ``length``-byte windows that share their smallest ``k``-byte string.

    Yields, block by block, arrays (text index, start in the text, number of
    windows, hash of the smallest string, hash of the run's whole bytes).  The
    choice depends on a window's bytes alone, so equal windows always carry
    the same first hash.  A run may be cut where a block ends.
    """
    w = length - k + 1
    lo, n = 0, int(off[-1])
    while lo < n:
        hi = min(lo + BLOCK, n)
        to = min(hi + length - 1, n)
        d = data[lo:to]
        if len(d) >= length:
            p, q = _powers(len(d) + 1)
            c = np.zeros(len(d) + 1, dtype=U64)
            np.cumsum(CODES[d] * p[: len(d)], dtype=U64, out=c[1:])
            h = mix((c[k:] - c[:-k]) * q[: len(d) - k + 1])
            low = U64((1 << 21) - 1)
            best = sliding_min((h & ~low) | np.arange(len(h), dtype=U64), w)
            text = np.searchsorted(off, np.arange(lo, lo + len(best)), side="right") - 1
            ok = np.arange(lo, lo + len(best)) + length <= off[text + 1]
            at = (best & low).astype(np.int64)
            new = np.ones(len(best), dtype=bool)
            new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | (ok[1:] != ok[:-1])
            s = np.flatnonzero(new)
            e = np.append(s[1:], len(best))
            s, e = s[ok[s]], e[ok[s]]
            g = mix((c[e + length - 1] - c[s]) * q[s] + (e - s).astype(U64))
            yield text[s], s + lo - off[text[s]], e - s, h[at[s]], g
        lo = hi
