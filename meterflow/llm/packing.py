"""Best-fit packing of tokenised documents into sequences of bounded length.

A task takes its documents in order and keeps a fixed number of open bins.
The bins' free spaces are a bitset, so the fullest bin that still holds a
piece is the lowest set bit at or above the piece's length.  If no open bin
holds it and all places are taken, the fullest bin closes and a new one opens.
Bins still open when a task ends are taken apart, gathered from many tasks and
packed again, round after round, until one task is left: only the lengths of
open bins move, a fixed number of bins for each task of the round before.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.components import settle
from meterflow.llm.kernel import pieces as text_slices
from meterflow.llm.vocab import SLICE, Memo, byte_level, json_tokenizer, plain_words, slices

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
#: Id that ends a document.
END = 1
#: Open bins of a task.
OPEN_BINS = 512
#: Tasks whose open bins one task of the next round takes.
GATHER = 64
#: Stands between parts that are encoded together: a character that is a token of its own between spaces.
_MARK = "\x01"
_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")
# between a letter or digit and a sign other than an apostrophe, tokens always end
_SIGN = rb"[!-&(-/:-@\[-`{-~]"
_INSIDE = re.compile(rb"(?<=[a-z0-9])(?=" + _SIGN + rb")|(?<=" + _SIGN + rb")(?=[a-z0-9])")
#: A word that case folding and composition leave as it is: a-z and the small letters of Latin-1.
_WORD = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
#: What the strings of special tokens start with; they are case-sensitive and never cut.
_SPECIAL = b"<|"


class WordIds:
    """Ids of whole texts as little-endian 32-bit integers.

    The tokenizer drops white space and joins nothing across it, so the ids
    of a text are those of its space-separated parts one after the other.
    It folds case, so A-Z are folded first: fewer parts differ.
    """

    def __init__(self, vocabulary: str):
        self.tokenizer = json_tokenizer(vocabulary, False)
        self.words, vocab = plain_words(vocabulary), self.tokenizer.get_vocab()
        self.level = {b: c for c, b in byte_level().items() if b > 127}
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for t, i in vocab.items() if t.endswith(self.tokenizer.model.end_of_word_suffix)]] = True
        self.mark = self.tokenizer.encode(f"a {_MARK} a", add_special_tokens=False).ids[1]
        if not all(t.content.encode().startswith(_SPECIAL) for t in self.tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("a special token has another form")
        self.memo = Memo(self._encode, split=lambda part: [part] if _SPECIAL in part else _INSIDE.split(part))

    def _alone(self, part: bytes) -> bytes:
        return np.array(self.tokenizer.encode(part.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def _encode(self, parts: list[bytes]) -> list[bytes]:
        out = {p: self._alone(p) for p in parts if _MARK.encode() in p or _SPECIAL in p}
        words = [p for p in parts if _WORD.fullmatch(p)]
        if words:
            text = b" ".join(words).decode("latin-1").translate(self.level)
            ids = np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            out |= self._runs(words, ids, np.flatnonzero(self.ends_word[ids])[:-1] + 1, 0)
        rest = [p for p in parts if p not in out]
        if rest:
            ids = np.array(self.tokenizer.encode(f" {_MARK} ".join(p.decode() for p in rest), add_special_tokens=False).ids, "<u4")
            out |= self._runs(rest, ids, np.flatnonzero(ids == self.mark), 1)
        return [out[p] for p in parts]

    @staticmethod
    def _runs(parts: list[bytes], ids: np.ndarray, at: np.ndarray, skip: int) -> dict[bytes, bytes]:
        """The ids of each part: runs that end at ``at``, with ``skip`` ids between them."""
        if len(at) != len(parts) - 1:
            raise ValueError("the vocabulary does not keep the parts apart")
        raw = ids.tobytes()
        return {p: raw[4 * lo: 4 * hi] for p, lo, hi in zip(parts, [0, *(at + skip).tolist()], [*at.tolist(), len(ids)])}

    @staticmethod
    def _parts(text: bytes) -> list[bytes]:
        return (text if _SPECIAL in text else text.lower()).split()

    def texts(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text."""
        parts = [self._parts(t or b"") if len(t or b"") <= SLICE else None for t in texts]
        self.memo.learn(set().union(*(p for p in parts if p)))
        known = self.memo.known.__getitem__
        out = [None if p is None else b"".join(map(known, p)) for p in parts]
        return [self._long(t) if ids is None else ids for t, ids in zip(texts, out)]

    def _long(self, text: bytes) -> bytes:
        out = []
        for part in slices(text, _SPACE):
            words = self._parts(part)
            self.memo.learn(set(words))
            out.append(b"".join(map(self.memo.known.__getitem__, words)))
        return b"".join(out)


@lru_cache(maxsize=2)
def _word_ids(vocabulary: str) -> WordIds:
    return WordIds(vocabulary)


class OpenBins:
    """Online best-fit with at most ``places`` open bins, kept by their free space.

    A bin is a list: its id, then its pieces as (item, offset).
    """

    def __init__(self, capacity: int, places: int, first_id: int):
        self.capacity, self.places, self.next_id = capacity, places, first_id
        self.free = 0  # the bitset: bit f says that some open bin has f free
        self.at: dict[int, list] = {}  # free space -> open bins
        self.count = 0

    def _new(self) -> list:
        self.next_id += 1
        return [self.next_id - 1]

    def _take(self, bits: int, above: int = 0) -> tuple[int, list]:
        """An open bin of the smallest free space in ``bits``, which start at ``above``."""
        space = above + (bits & -bits).bit_length() - 1
        same = self.at[space]
        box = same.pop()
        if not same:
            del self.at[space]
            self.free &= ~(1 << space)
        self.count -= 1
        return space, box

    def add(self, length: int, item) -> list | None:
        """Place an item of 1 to ``capacity``; the bin that this closes, if any."""
        fits, closed = self.free >> length, None
        if fits:
            space, box = self._take(fits, length)
        else:
            space, box = self.capacity, self._new()
            if length < space and self.count == self.places:
                closed = self._take(self.free)[1]  # the fullest closes first
        box.append((item, self.capacity - space))
        space -= length
        if not space:
            return box
        self.at.setdefault(space, []).append(box)
        self.free |= 1 << space
        self.count += 1
        return closed

    def rest(self) -> list[list]:
        """The open bins."""
        return [box for same in self.at.values() for box in same]


def _placed(items, capacity: int, places: int, turn: int):
    """Rows (item, sequence id, offset, still open) of one task; ``items``: tuples whose fourth entry is the length.

    Items are fed in runs of ``places``, the longest of a run first.
    """
    bins = OpenBins(capacity, places, turn << 56 | TaskContext.get().partitionId() << 32)
    run: list = []

    def fed():
        for x in sorted(run, key=lambda x: -x[3]):
            box = bins.add(x[3], x)
            if box:
                yield from ((item, box[0], offset, False) for item, offset in box[1:])
        run.clear()

    for x in items:
        run.append(x)
        if len(run) == places:
            yield from fed()
    yield from fed()
    for box in bins.rest():
        yield from ((item, box[0], offset, True) for item, offset in box[1:])


_FIELDS = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("ids_crc32", pa.int64())]
_OUT = pa.schema([*_FIELDS, ("sequence_id", pa.int64()), ("offset", pa.int64()), ("task", pa.int32()), ("open", pa.bool_())])
_OUT_SQL = ("doc_id long, piece int, start long, length long, ids binary, ids_crc32 long, sequence_id long, offset long, task int, open boolean")


def _batches(rows, size: int = 4096):
    task = TaskContext.get().partitionId()
    held: list = []

    def batch():
        cols = list(zip(*((*item, seq, offset, task, is_open) for item, seq, offset, is_open in held)))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _OUT)], schema=_OUT)

    for r in rows:
        held.append(r)
        if len(held) == size:
            yield batch()
    if held:
        yield batch()


def _first_turn(vocabulary: str, capacity: int, places: int, ids: bool):
    def items(batches):
        words = _word_ids(vocabulary)
        end = np.array([END], "<u4").tobytes()
        for b in (part for whole in batches for part in text_slices(whole)):
            texts = b.column("text").cast(pa.binary()).to_pylist()
            for doc_id, raw in zip(b.column("doc_id").to_pylist(), words.texts(texts)):
                raw += end
                for piece, lo in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[lo: lo + 4 * capacity]
                    yield doc_id, piece, lo // 4, len(part) // 4, part if ids else None, zlib.crc32(part)

    def run(batches):
        yield from _batches(_placed(items(batches), capacity, places, 0))
    return run


def _next_turn(capacity: int, places: int, turn: int):
    def run(batches):
        rows = (x for b in batches for x in zip(*(b.column(name).to_pylist() for name, _ in _FIELDS)))
        yield from _batches(_placed(rows, capacity, places, turn))
    return run


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, places: int = OPEN_BINS, ids: bool = True) -> DataFrame:
    """Tokens of every document (``doc_id``, ``text``) packed into sequences of at most ``capacity``.

    A document is its ids by ``vocabulary`` and the id ``END``; only documents
    longer than ``capacity`` are cut, into pieces of ``capacity`` and a rest.
    Returns one row for each piece: ``doc_id``, ``piece``, ``start`` (ids of
    the document before it), ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset`` (its place there; a sequence has no gaps), and ``ids``
    (little-endian 32-bit, null unless ``ids``).  Null and empty texts are
    documents of one id.  Rows with a null or repeated ``doc_id`` are documents
    of their own; other columns are ignored; an empty table gives no rows.
    Very long texts are encoded in slices.  Among bins of equal free space the
    one filled last is used.  The result is read from written tables, so it
    does not change when it is computed again.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    now = settle(d.mapInArrow(_first_turn(vocabulary, capacity, places, ids), _OUT_SQL), "packed")
    tasks, turn, done = now.where("open").select("task").distinct().count(), 0, None
    while tasks > 1:
        tasks, turn = -(-tasks // GATHER), turn + 1
        closed = now.where("NOT open")
        done = closed if done is None else done.union(closed)
        again = now.where("open").select(*(name for name, _ in _FIELDS)).repartition(tasks, "doc_id", "piece", "ids_crc32")
        now = settle(again.mapInArrow(_next_turn(capacity, places, turn), _OUT_SQL), "packed")
    return (now if done is None else done.union(now)).drop("task", "open")


def _joined(batches):
    for b in batches:
        ids = [np.frombuffer(b"".join(parts), "<u4").astype(np.int32) for parts in b.column("ids").to_pylist()]
        ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
        flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
        yield pa.RecordBatch.from_arrays([b.column("sequence_id"), b.column("doc_ids"), pa.ListArray.from_arrays(ends, pa.array(flat))],
                                         ["sequence_id", "doc_ids", "ids"])


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves (``sequence_id``, ``doc_ids`` of the pieces, ``ids`` as integers) from rows that carry their ``ids``."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))  # at most ``capacity`` pieces
    parts = parts.select("sequence_id", F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"), F.transform("p", lambda x: x["ids"]).alias("ids"))
    return parts.mapInArrow(_joined, "sequence_id long, doc_ids array<long>, ids array<int>")


def op13_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), ids=False).drop("ids")
