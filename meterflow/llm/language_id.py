"""Language ID by rank-order profiles.

A language's profile lists its most frequent letter n-grams (one to three
letters, a word's edge counts as a letter) over all its learning documents.
A document is compared by its own most frequent n-grams: each contributes the
distance between its two ranks, or the longest distance where the language's
profile lacks it.  The language with the smallest sum wins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from meterflow.llm.kernel import text_buffers

#: Ranks in a language's profile, and n-grams a document is compared by.
RANKS = 400
DOC_RANKS = 400
#: Characters worked on at once.
BLOCK = 1 << 18
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Lower-case letter of each code point, 0 where it is no letter."""
    if not _LETTERS:
        t = np.zeros(0x110000, np.int32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                t[c] = ord(s.lower()[0])
        _LETTERS.append(t)
    return _LETTERS[0]


def _code_points(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    try:
        cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[off]
    except UnicodeDecodeError:
        texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:])]
        at = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return cp, at


def document_grams(data: np.ndarray, off: np.ndarray):
    """Yield each text's n-grams (63-bit codes, in no order)."""
    lo, n = 0, len(off) - 1
    while lo < n:  # blocks of whole texts
        hi = int(max(lo + 1, np.searchsorted(off, off[lo] + BLOCK, side="right") - 1))
        cp, at = _code_points(data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo])
        x = _letters()[cp]
        # an edge before, between and after words; texts share none
        x = np.insert(x, at, 0).astype(np.int64)
        at = at + np.arange(len(at))
        keep = np.ones(len(x), bool)
        keep[1:] = (x[1:] != 0) | (x[:-1] != 0)
        keep[at] = True
        place = np.concatenate(([0], np.cumsum(keep)))
        at, x = place[at], x[keep]
        two = (x[:-1] << 21) | x[1:]
        three = (two[:-1] << 21) | x[2:]
        ok2 = two != 0
        ok3 = (x[1:-1] != 0)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):  # edges at a and b
            one = x[a + 1: b]
            t2, t3 = two[a:b], three[a: max(a, b - 1)]
            yield np.concatenate((one[one != 0], t2[ok2[a:b]] | (1 << 42), t3[ok3[a: max(a, b - 1)]] | (1 << 63 - 1)))
        lo = hi


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.empty(0, np.int64)
    return k[first], np.diff(np.append(first, len(k)))


def _count_task(batches):
    """Counts of a task's n-grams by language, summed before the shuffle."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for b in batches:
        parts: dict[str, list] = {}
        for lang, keys in zip(b.column("lang").to_pylist(), document_grams(*text_buffers(b.column("text")))):
            parts.setdefault(lang, []).append(keys)
            if sum(map(len, parts[lang])) > BLOCK // 2:
                held[lang] = _add(held.get(lang), parts.pop(lang))
        for lang, p in parts.items():
            held[lang] = _add(held.get(lang), p)
    for lang, (k, c) in held.items():
        for a in range(0, len(k), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k[a: a + 50_000]), pa.string()), pa.array(k[a: a + 50_000]), pa.array(c[a: a + 50_000])], ["lang", "gram", "c"])


def _add(have, parts):
    k, c = _counted(np.concatenate(parts))
    if have is None:
        return k, c
    both, n = np.concatenate((have[0], k)), np.concatenate((have[1], c))
    o = np.argsort(both, kind="stable")
    both, n = both[o], n[o]
    first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
    return both[first], np.add.reduceat(n, first)


def learn_profiles(docs: DataFrame, ranks: int = RANKS) -> DataFrame:
    """Rows (``lang``, ``gram``, ``rank`` from 0) of the profiles over all rows of ``docs`` with a ``lang``."""
    counts = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text").mapInArrow(_count_task, "lang string, gram long, c long")
    total = counts.groupBy("lang", "gram").agg(F.sum("c").alias("c"))
    w = Window.partitionBy("lang").orderBy(F.desc("c"), "gram")
    # the limit stands on the row number itself, so that tasks drop what can't be in a profile before the shuffle
    return total.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= ranks).select("lang", "gram", (F.col("rn") - 1).alias("rank"))


class Profiles:
    """The languages' ranks as one table: a row for each language, a column for each known n-gram."""

    def __init__(self, rows: list, ranks: int):
        self.ranks, self.langs = ranks, sorted({r["lang"] for r in rows})
        self.grams = np.unique(np.array([r["gram"] for r in rows], np.int64))
        self.table = np.full((len(self.langs), len(self.grams) + 1), -1, np.int32)
        at = {x: i for i, x in enumerate(self.langs)}
        for r in rows:
            self.table[at[r["lang"]], np.searchsorted(self.grams, r["gram"])] = r["rank"]
        # grams of equal count in a document rank by their best rank in any language
        best = np.where(self.table < 0, ranks, self.table)
        self.best = best.min(axis=0) if self.langs else np.empty(0)

    def predict(self, keys: np.ndarray) -> tuple[str, float]:
        if not len(keys) or not self.langs:
            return "und", 0.0
        k, c = _counted(keys)
        i = np.minimum(np.searchsorted(self.grams, k), len(self.grams) - 1)
        i = np.where(self.grams[i] == k, i, len(self.grams))
        top = np.lexsort((k, self.best[i], -c))[:DOC_RANKS]
        known = self.table[:, i[top]]
        d = np.where(known < 0, self.ranks, np.minimum(np.abs(known - np.arange(len(top))), self.ranks)).sum(axis=1)
        best = int(d.argmin())  # ties: the first language by name
        return self.langs[best], 1.0 - float(d[best]) / (self.ranks * len(top))


def _predict(shared):
    def run(batches):
        p = shared.value
        for b in batches:
            found = [p.predict(k) for k in document_grams(*text_buffers(b.column("text")))]
            cols = [*b.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, [*b.schema.names, "lang_pred", "score"])
    return run


def identify(docs: DataFrame, profiles: DataFrame, keep: list[str], ranks: int = RANKS) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to the columns ``keep`` of ``docs``; ``text`` is read whole.

    A null text, or one without letters, gives ``und`` and 0, as does any text
    where nothing was learned.  The score is 1 minus the distance as a share
    of the longest possible one.  A profile is at most ``ranks`` rows, so all
    languages' profiles together are small whatever the corpus.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Profiles(profiles.collect(), ranks))
    d = docs.select(*keep, F.col("text").cast("string").alias("text")) if "text" not in keep else docs.select(*keep)
    schema = StructType([*d.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return d.mapInArrow(_predict(shared), schema)


def held_out(doc_id: str, parts: int, rest: int):
    """Whether crc32 of the id's text leaves ``rest``; false for a null id."""
    return F.coalesce(F.expr(f"crc32(cast({doc_id} AS string)) % {parts} = {rest}"), F.lit(False))


def language_predictions(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row.

    Learns from rows with a non-null id, text and ``lang`` that are not held
    out.  Repeated rows count as often as they occur; other columns are
    ignored; an empty table gives an empty result.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    learned = learn_profiles(d.where(F.col("doc_id").isNotNull() & ~held_out("doc_id", 4, 2)))
    out = identify(d.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "text"), learned, ["doc_id", "held_out", "text"])
    return out.select("doc_id", "held_out", "lang_pred", "score")


def stage_language_id(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose language can't be told (``und``) go; the others stay as they are."""
    learned = learn_profiles(docs.where(F.col("doc_id").isNotNull() & ~held_out("doc_id", 4, 2)).select(F.col("lang").cast("string").alias("lang"), "text"))
    row = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    return identify(row, learned, ["row", "text"]).where("lang_pred <> 'und'").select("row.*")


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    return language_predictions(spark.read.parquet(f"{sf_dir}/documents.parquet"))
