"""Alignment of two tokenizers by galloping intersection of their token ends.

1. Every text is encoded by both; the ends of its tokens are byte offsets.
2. The shorter list of ends drives: each of its entries gallops into the
   longer one, by steps that double and then a binary search.  All entries of
   a slice of texts do so in step; every 32nd starts at its text's first token,
   the others start where the one before them in this grid has landed.
3. The common ends cut a text into groups; the differences of their ranks in
   either list are the ranges of tokens that a group holds.
4. Token pairs that end together are counted over the corpus, first within a
   text, and every text's pairs are scored by these counts.
"""

from __future__ import annotations

import re
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.components import settle
from meterflow.llm.kernel import pieces as text_slices
from meterflow.llm.vocab import MEMO, SLICE, Memo, byte_level, json_tokenizer, piece_tokenizer, slices

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Pair tables of at most so many rows (some tens of MB) are broadcast; larger ones join by shuffle.
BROADCAST_PAIRS = 500_000
#: Distance of the entries that gallop from their text's start.
GRID = 32
#: A piece vocabulary's sign for a space.
_SPACE_SIGN = "▁"
# white space, as UTF-8, that the byte vocabulary's pattern knows, and control characters beside it
_WHITE = rb"[ \t\n\r\x0b\x0c\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
#: A space next to white space, or at the end: a text with one is cut at other spaces only.
_ODD = re.compile(rb" (?=" + _WHITE + rb"|$)")
_STARTS_WHITE = re.compile(_WHITE)
_SAFE = re.compile(rb"(?<=[!-~]) (?=[!-~])")


def _piece_bytes(model, i: int) -> bytes:
    p = model.id_to_piece(i)
    return bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(_SPACE_SIGN, " ").encode()


class TwoEncodings:
    """Ids of whole texts under both vocabularies, as little-endian 16- or 32-bit integers.

    Neither vocabulary has a token that goes on after a space, so the ids of
    a text are those of its parts, each with the space before it.
    """

    def __init__(self, byte_vocabulary: str, piece_vocabulary: str):
        self.a, self.b = json_tokenizer(byte_vocabulary, True), piece_tokenizer(piece_vocabulary)
        level = byte_level()
        size = max(self.a.get_vocab().values()) + 1
        self.a_bytes = [b""] * size
        for t, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(level[c] for c in t) if all(c in level for c in t) else t.encode()
        self.b_bytes = [_piece_bytes(self.b, i) for i in range(self.b.get_piece_size())]
        if any(re.search(b"[^ ] ", t) for t in self.b_bytes):
            raise ValueError("a piece goes on after a space")
        self.a_size, self.b_size = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        self.a_memo, self.b_memo = Memo(self._encode_a, MEMO // 2), Memo(self._encode_b, MEMO // 2)
        self.lossy: set[bytes] = set()  # known parts whose joined tokens are not the part

    def _ids_a(self, text: str) -> np.ndarray:
        return np.array(self.a.encode(text, add_special_tokens=False).ids, "<u4")

    def _ids_b(self, text: str) -> np.ndarray:
        return np.array(self.b.encode(text, num_threads=1), "<u4")

    def _encode(self, parts, whole, table, size, alone):
        """Ids of each part: of all in one call, split where their bytes end, but for those that must be read alone."""
        joined = [p for p in parts if not alone(p)]
        text = b"".join(b" " + p for p in joined)
        ids = whole(text.decode()[1:] if table is self.b_bytes else text.decode()) if joined else np.empty(0, "<u4")
        ends = np.cumsum(size[ids])
        want = np.cumsum([len(p) + 1 for p in joined])
        at = np.searchsorted(ends, want)
        fits = joined and len(ends) and at[-1] == len(ends) - 1 and (ends[at] == want).all() and b"".join(map(table.__getitem__, ids.tolist())) == text
        raw, out = ids.tobytes(), {}
        if fits:
            out = {p: raw[4 * lo: 4 * hi] for p, lo, hi in zip(joined, [0, *(at + 1).tolist()], (at + 1).tolist())}
        for p in parts:
            if p not in out:
                own = whole(p.decode() if table is self.b_bytes else " " + p.decode())
                if b"".join(map(table.__getitem__, own.tolist())) != b" " + p:
                    self.lossy.add(p)
                out[p] = own.tobytes()
        return [out[p] for p in parts]

    def _encode_a(self, parts):
        return self._encode(parts, self._ids_a, self.a_bytes, self.a_size, lambda p: not p or p[-1:] == b" " or _STARTS_WHITE.match(p))

    def _encode_b(self, parts):
        sign = _SPACE_SIGN.encode()
        return self._encode(parts, self._ids_b, self.b_bytes, self.b_size, lambda p: not p or b" " in (p[:1], p[-1:]) or sign in p)

    def _known(self, parts: set[bytes]) -> None:
        if len(self.lossy) > MEMO // 2:
            self.lossy &= self.a_memo.known.keys() | self.b_memo.known.keys()
        self.a_memo.learn(parts)
        self.b_memo.learn(parts)

    @staticmethod
    def _parts(text: bytes) -> list[bytes]:
        """Parts of ``text``, each with a space before it in space+text."""
        return _SAFE.split(text) if _ODD.search(text) or _STARTS_WHITE.match(text) else text.split(b" ")

    def _joined(self, parts: list[bytes]) -> tuple[bytes, bytes] | None:
        if self.lossy and not self.lossy.isdisjoint(parts):
            return None
        return b"".join(map(self.a_memo.known.__getitem__, parts)), b"".join(map(self.b_memo.known.__getitem__, parts))

    def texts(self, texts: list[bytes | None]) -> list[tuple[bytes, bytes]]:
        """Ids of each text; none for empty texts and those whose tokens don't join to space+text."""
        parts = [self._parts(t) if t and len(t) <= SLICE else None for t in texts]
        self._known(set().union(*(p for p in parts if p)))
        out = [self._joined(p) or (b"", b"") if p else (b"", b"") for p in parts]
        for k, t in enumerate(texts):
            if t and len(t) > SLICE:
                out[k] = self._long(t)
        return out

    def _long(self, text: bytes) -> tuple[bytes, bytes]:
        runs = []
        for part in slices(text, _SAFE):
            parts = self._parts(part)
            self._known(set(parts))
            runs.append(self._joined(parts))
            if runs[-1] is None:
                return b"", b""
        return b"".join(r[0] for r in runs), b"".join(r[1] for r in runs)


@lru_cache(maxsize=2)
def _two_encodings(byte_vocabulary: str, piece_vocabulary: str) -> TwoEncodings:
    return TwoEncodings(byte_vocabulary, piece_vocabulary)


def _search(drive: np.ndarray, into: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Place in ``into`` of the first entry at or above each of ``drive``, galloping up from ``lo``; there is one."""
    last = len(into) - 1
    lo, hi = lo.copy(), lo.copy()
    todo, step = np.flatnonzero(into[hi] < drive), 1
    while len(todo):  # steps that double
        lo[todo] = hi[todo] + 1
        hi[todo] = np.minimum(hi[todo] + step, last)
        todo, step = todo[into[hi[todo]] < drive[todo]], 2 * step
    todo = np.flatnonzero(lo < hi)
    while len(todo):  # binary search between the last two steps
        mid = (lo[todo] + hi[todo]) >> 1
        low = into[mid] < drive[todo]
        lo[todo[low]], hi[todo[~low]] = mid[low] + 1, mid[~low]
        todo = todo[lo[todo] < hi[todo]]
    return lo


def gallop(drive: np.ndarray, into: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common entries of ascending lists, as indices into ``drive`` and ``into``.

    ``drive`` holds lists of ``sizes`` one after the other; the list ``k`` is
    met in ``into`` from index ``starts[k]`` on, where no smaller entry of it
    can lie below.  ``into`` reaches as far as ``drive``.
    """
    if not len(drive):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.cumsum(sizes) - sizes
    rank = np.arange(len(drive)) - np.repeat(first, sizes)
    anchor = np.flatnonzero(rank % GRID == 0)
    landed = _search(drive[anchor], into, np.repeat(starts, sizes)[anchor])
    at = _search(drive, into, landed[np.searchsorted(anchor, np.arange(len(drive)), side="right") - 1])
    hit = np.flatnonzero(into[at] == drive)
    return hit, at[hit]


def common_ends(a_end: np.ndarray, b_end: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the token ends that both sides have, text by text in order.

    ``a_end`` and ``b_end`` rise over all texts; ``n_a`` and ``n_b`` are the texts' numbers of tokens.
    """
    a_first, b_first = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    a_drives = n_a <= n_b
    in_a, in_b = np.repeat(a_drives, n_a), np.repeat(~a_drives, n_b)
    hit_a, at_b = gallop(a_end[in_a], b_end, n_a[a_drives], b_first[a_drives])
    hit_b, at_a = gallop(b_end[in_b], a_end, n_b[~a_drives], a_first[~a_drives])
    a = np.concatenate((np.flatnonzero(in_a)[hit_a], at_a))
    b = np.concatenate((at_b, np.flatnonzero(in_b)[hit_b]))
    order = np.argsort(a, kind="stable")
    return a[order], b[order]


def _group_text(a, b, ca, cb, cut) -> list[bytes]:
    """The groups of each text as ``a1,a2|b1;a3|b2``; ``cut``: the first group of each text and the end."""
    a_size, b_size = np.diff(ca, prepend=-1), np.diff(cb, prepend=-1)
    group_a, group_b = np.repeat(np.arange(len(ca)), a_size), np.repeat(np.arange(len(cb)), b_size)
    token = np.empty(len(a) + len(b), np.int64)
    sign = np.full(len(token), ord(","), np.uint8)
    at_a = np.arange(len(a)) + (cb - b_size + 1)[group_a]
    at_b = np.arange(len(b)) + (ca + 1)[group_b]
    token[at_a], token[at_b] = a, b
    sign[at_a[ca]], sign[at_b[cb]] = ord("|"), ord(";")
    width = len(str(int(token.max(initial=0))))
    digits = np.empty((len(token), width + 1), np.uint8)
    shown = np.ones((len(token), width + 1), bool)
    rest = token
    for k in range(width - 1, -1, -1):
        shown[:, k] = (rest > 0) | (k == width - 1)
        rest, d = np.divmod(rest, 10)
        digits[:, k] = d + 48
    digits[:, width] = sign
    raw = digits[shown].tobytes()
    ends = np.cumsum(shown.sum(1))[at_b[cb]] if len(cb) else np.empty(0, np.int64)
    ends = np.concatenate(([0], ends))[cut]
    return [raw[lo: max(hi - 1, lo)] for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _lists(values: np.ndarray, ends: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(values, kind))


def _align(byte_vocabulary: str, piece_vocabulary: str, whole: bool):
    def run(batches):
        two = _two_encodings(byte_vocabulary, piece_vocabulary)
        for b in (part for batch in batches for part in text_slices(batch)):
            coded = two.texts(b.column("text").cast(pa.binary()).to_pylist())
            ids_a, ids_b = (np.frombuffer(b"".join(c[k] for c in coded), "<u4") for k in (0, 1))
            n_a, n_b = (np.array([len(c[k]) // 4 for c in coded], np.int64) for k in (0, 1))
            ca, cb = common_ends(np.cumsum(two.a_size[ids_a]), np.cumsum(two.b_size[ids_b]), n_a, n_b)
            cut = np.searchsorted(ca, np.concatenate(([0], np.cumsum(n_a))))  # groups before each text
            text = np.repeat(np.arange(len(coded)), np.diff(cut))
            code = ids_a[ca].astype(np.int64) * len(two.b_bytes) + ids_b[cb]
            order = np.lexsort((code, text))
            code, text = code[order], text[order]
            new = np.ones(len(code), bool)
            new[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(code)))
            ends = np.searchsorted(text[first], np.arange(len(coded) + 1))
            shas = [sha256(g).hexdigest() if g else "" for g in _group_text(ids_a, ids_b, ca, cb, cut)]
            out = [b.column("doc_id"), pa.array(n_a), pa.array(n_b), pa.array(np.diff(cut)), pa.array(shas),
                   _lists(code[first], ends, pa.int64()), _lists(times, ends, pa.int32())]
            if whole:
                out += [_lists(ids_a.astype(np.int32), np.concatenate(([0], np.cumsum(n_a))), pa.int32()),
                        _lists(ids_b.astype(np.int32), np.concatenate(([0], np.cumsum(n_b))), pa.int32()),
                        _lists(np.diff(ca, prepend=-1), cut, pa.int32()), _lists(np.diff(cb, prepend=-1), cut, pa.int32())]
            yield pa.RecordBatch.from_arrays(out, _NAMES + (_WHOLE if whole else []))
    return run


_NAMES = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"]
_WHOLE = ["a_ids", "b_ids", "a_sizes", "b_sizes"]
_SQL = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<int>"
_WHOLE_SQL = ", a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>"


def align(docs: DataFrame, byte_vocabulary: str = BYTE_VOCABULARY, piece_vocabulary: str = PIECE_VOCABULARY, whole: bool = True) -> DataFrame:
    """Both tokenizations of every document (``doc_id``, ``text``) and the groups they share.

    Returns ``rid`` (a row number), ``doc_id``, ``n_a``, ``n_b``,
    ``n_groups``, ``groups_sha256``, ``pairs`` (distinct id pairs that end a
    group, as ``a * size of the piece vocabulary + b``) and ``times`` (how
    often); with ``whole``, also the ids (``a_ids``, ``b_ids``) and the number
    of tokens in each group (``a_sizes``, ``b_sizes``).  Texts that are null,
    empty or not restored by their tokens (such as those with U+2581) have no
    tokens.  Rows with a null or repeated ``doc_id`` are rows of their own;
    other columns are ignored; an empty table gives no rows.  Very long texts
    are encoded in slices.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = d.mapInArrow(_align(byte_vocabulary, piece_vocabulary, whole), _SQL + (_WHOLE_SQL if whole else ""))
    return settle(out.withColumn("rid", F.monotonically_increasing_id()), "aligned")


def pair_counts(aligned: DataFrame, piece_size: int) -> DataFrame:
    """Each linked pair of ids (``pair``), its links in the corpus (``c``) and whether no pair of its B id has more (``best``)."""
    counts = (aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair"))
              .agg(F.sum("x.times").alias("c")).withColumn("b", F.col("pair") % F.lit(piece_size)))
    counts = settle(counts, "pair-counts")
    most = counts.groupBy("b").agg(F.max("c").alias("most"))
    return counts.join(most, "b").select("pair", "c", (F.col("c") == F.col("most")).alias("best"))


def score(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``aligned`` with ``n_links``, ``n_best`` (links whose pair is the commonest of its B id, ties included) and ``count_sum``."""
    counts = settle(counts, "pairs")
    if counts.limit(BROADCAST_PAIRS + 1).count() <= BROADCAST_PAIRS:
        counts = F.broadcast(counts)
    links = aligned.select("rid", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("rid", F.col("x.pairs").alias("pair"), F.col("x.times").cast("long").alias("m"))
    sums = links.join(counts, "pair").groupBy("rid").agg(
        F.sum("m").alias("n_links"), F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("n_best"), F.sum(F.col("m") * F.col("c")).alias("count_sum"))
    none = F.lit(0).cast("long")
    return aligned.drop("pairs", "times").join(sums, "rid", "left").withColumns({c: F.coalesce(c, none) for c in ("n_links", "n_best", "count_sum")})


def op12_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    both = align(spark.read.parquet(f"{sf_dir}/documents.parquet"), whole=False)
    scored = score(both, pair_counts(both, piece_tokenizer(PIECE_VOCABULARY).get_piece_size()))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
