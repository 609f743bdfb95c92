"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A bounded sample of labelled rows is cut in three by the hash of the id: one
part finds the lexicon (words, word beginnings and words with look-alike
characters undone, held as hashes), one grows the trees, one calibrates.
Features are densities of lexicon words, their nearness to second-person
words, and rates of capitals, punctuation and obfuscated words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.components import cut, settle
from meterflow.llm.kernel import CODES_LOWER, U64, mix, pieces, text_buffers, word_hashes, word_spans
from meterflow.llm.language_id import held_out
from meterflow.llm.quality import SAMPLE, labelled_sample
from meterflow.llm.text_stats import byte_counts, per_text, share

#: Lexicon entries at most; an entry occurs in so many toxic documents, and so many times more often in them.
ENTRIES, LEAST_DOCS, LEAST_RATIO = 500, 8, 12.0
#: Bytes of the word beginnings that may be entries.
BEGINNINGS = (4, 5, 6)
#: Words on either side within which a second-person word counts as near.
NEAR = 6
#: Second-person words of the languages at hand.
SECOND_PERSON = ("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch sie "
                 "ti tú usted ustedes vosotros os su sus").split()

#: A word is a run of ASCII letters, digits, look-alike signs and bytes beyond ASCII.
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[65:91] = IS_WORD[97:123] = IS_WORD[128:] = True
IS_WORD[[ord(c) for c in "@$*"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
#: Look-alike characters and the letters they stand for.
LOOK_ALIKE = dict(zip("013457@$", "oieastas"))
_PLAIN = CODES_LOWER.copy()
for _a, _b in LOOK_ALIKE.items():
    _PLAIN[ord(_a)] = CODES_LOWER[ord(_b)]

FEATURES = ["words_density", "starts_density", "plain_density", "hits", "near_you", "you", "upper", "shout_words", "stops", "shouts", "digits", "obfuscated", "log_words"]


class Words:
    """Hashes of a batch's words, their beginnings, and their look-alike forms."""

    def __init__(self, col):
        self.data, self.off = data, off = text_buffers(col)
        self.full, self.w = word_hashes(data, off, IS_WORD, CODES_LOWER)
        self.starts, self.odd, self.loud = [], np.empty(0, bool), np.empty(0, bool)
        s, e = word_spans(data, off, IS_WORD, 0, len(data)) if len(data) else (np.empty(0, np.int64),) * 2
        size = e - s
        for b in BEGINNINGS:
            h = np.full(len(s), b, U64)
            for i in range(b):
                h = mix(h ^ CODES_LOWER[data[np.minimum(s + i, max(len(data) - 1, 0))]]) if len(s) else h
            self.starts.append(np.where(size > b, h, U64(0)))
        if len(s):
            letters = np.concatenate(([0], np.cumsum(_LETTER[data], dtype=np.int64)))
            n = letters[e] - letters[s]
            self.odd = (n > 0) & (n < size)
            upper = np.concatenate(([0], np.cumsum((data >= 65) & (data <= 90), dtype=np.int64)))
            self.loud = (upper[e] - upper[s] == size) & (size > 2)
        self.plain = self._plain(s, e)

    def _plain(self, s, e):
        """Hashes of the odd words with look-alike characters undone, 0 for the others."""
        out = np.zeros(len(s), U64)
        i = np.flatnonzero(self.odd)
        if len(i):
            size = (e - s)[i]
            at = np.repeat(s[i] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum()))
            own = np.concatenate(([0], np.cumsum(size)))
            out[i] = word_hashes(self.data[at], own, IS_WORD, _PLAIN)[0]
        return out


def _terms(batches):
    """Distinct hashes of each labelled document, with a kind in place of a name."""
    for b in (piece for whole in batches for piece in pieces(whole)):
        x = Words(b.column("text"))
        label = np.asarray(b.column("label"))
        for i, (lo, hi) in enumerate(zip(x.w[:-1].tolist(), x.w[1:].tolist())):
            h = np.unique(np.concatenate([x.full[lo:hi], *(s[lo:hi] for s in x.starts)]))
            h = h[h != 0].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.full(len(h), label[i]))], ["term", "label"])


def learn_lexicon(texts: DataFrame) -> np.ndarray:
    """Hashes of the entries, from rows (``text``, ``label``); at most ENTRIES reach the driver."""
    n = texts.agg(F.sum("label").alias("p"), F.count("*").alias("n")).first()
    if not n["n"] or not n["p"] or n["p"] == n["n"]:
        return np.empty(0, U64)
    c = texts.mapInArrow(_terms, "term long, label double").groupBy("term").agg(F.sum("label").alias("p"), F.count("*").alias("c"))
    ratio = ((F.col("p") + 0.5) / n["p"]) / ((F.col("c") - F.col("p") + 0.5) / (n["n"] - n["p"]))
    rows = (c.where((F.col("p") >= min(LEAST_DOCS, max(2, n["p"] / 5))) & (ratio >= LEAST_RATIO))
            .orderBy(F.desc("p"), "term").limit(ENTRIES).collect())
    return np.sort(np.array([r["term"] for r in rows], np.int64).view(U64))


def _in(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known) or not len(h):
        return np.zeros(len(h), bool)
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


def _features(lexicon: np.ndarray):
    you = np.sort(word_hashes(*text_buffers(pa.array([" ".join(SECOND_PERSON)])), IS_WORD, CODES_LOWER)[0])

    def run(batches):
        for b in (piece for whole in batches for piece in pieces(whole)):
            x = Words(b.column("text"))
            n = np.diff(x.w)
            full, start, plain = _in(x.full, lexicon), np.zeros(len(x.full), bool), _in(x.plain, lexicon) & (x.plain != 0)
            for s in x.starts:
                start |= _in(s, lexicon)
            hit, second = full | start | plain, _in(x.full, you)
            near = _near(hit, second, x.w)
            c = byte_counts(x.data, x.off)
            size, letters = np.diff(x.off), c["upper"] + c["lower"]
            v = {"words_density": share(per_text(full, x.w), n), "starts_density": share(per_text(start, x.w), n),
                 "plain_density": share(per_text(plain, x.w), n), "hits": np.log1p(per_text(hit, x.w)),
                 "near_you": share(per_text(near, x.w), n), "you": share(per_text(second, x.w), n), "upper": share(c["upper"], letters),
                 "shout_words": share(per_text(x.loud, x.w), n), "stops": share(c["stop"], n), "shouts": share(c["shout"], n),
                 "digits": share(c["digit"], size), "obfuscated": share(per_text(x.odd, x.w), n), "log_words": np.log1p(n)}
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(np.asarray(v[f], np.float64)) for f in FEATURES)], ["doc_id", *FEATURES])
    return run


def _near(hit: np.ndarray, second: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Hits with a second-person word of the same text at most NEAR words away."""
    out = np.zeros(len(hit), bool)
    i, j = np.flatnonzero(hit), np.flatnonzero(second)
    if len(i) and len(j):
        text = np.searchsorted(w, i, side="right")
        for k in (np.searchsorted(j, i), np.searchsorted(j, i) - 1):
            k = np.clip(k, 0, len(j) - 1)
            ok = (np.abs(j[k] - i) <= NEAR) & (np.searchsorted(w, j[k], side="right") == text)
            out[i[ok]] = True
    return out


def toxicity_features(docs: DataFrame, lexicon: np.ndarray) -> DataFrame:
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(_features(lexicon), "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES))


#: Parts of the labelled rows: two for the lexicon, one for the trees, one for the calibration.
PARTS = 4


def _in_parts(chosen: DataFrame) -> tuple[DataFrame, int, int]:
    """The bounded sample with ``part``, dealt by label so that each part holds both; rows and rows of label 1.

    A label with fewer rows than parts can't be dealt: then all rows serve every part (a null ``part``).
    """
    n = chosen.agg(F.coalesce(F.sum("label"), F.lit(0)).alias("p"), F.count("*").alias("n")).first()
    if min(n["p"], n["n"] - n["p"]) < PARTS:
        return chosen.withColumn("part", F.lit(None).cast("int")), n["n"], int(n["p"])
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id")
    return cut(chosen.withColumn("part", F.pmod(F.row_number().over(order), F.lit(PARTS)))), n["n"], int(n["p"])


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``.

    Null and empty texts have zero features and a score like any other; a
    null id is never learned from and not held out; very long texts are read
    whole.  Lexicon, trees and calibration learn from disjoint rows, dealt by
    label; a label with fewer rows than parts leaves all rows to each.  Where
    the learning rows have one label only, the score is its rate; with none it
    is 0.  Texts of equal features have equal scores.  Repeated rows stay
    repeated; other columns are ignored; an empty table gives an
    empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    labelled = labelled_sample(labels, "toxic", 5, 0, sample)
    chosen, n, ones = _in_parts(cut(texts.select("doc_id").join(F.broadcast(labelled), "doc_id").distinct()))
    lexicon = learn_lexicon(texts.join(F.broadcast(chosen.where("part IS NULL OR part < 2")), "doc_id").select("text", "label"))
    rows = settle(toxicity_features(docs, lexicon), "toxicity")
    own = rows.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), *FEATURES)
    if ones in (0, n):
        score = F.lit(ones / n if n else 0.0)
        return own.select("doc_id", "held_out", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    known = cut(assemble.transform(rows.join(F.broadcast(chosen.where("part IS NULL OR part >= 2")), "doc_id")).select("features", "label", "part").coalesce(4))
    grow, hold = known.where("part IS NULL OR part = 2"), known.where("part IS NULL OR part = 3")
    trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.2, seed=7, maxBins=64, minInstancesPerNode=5).fit(grow)
    raw = lambda df: trees.transform(df).withColumn("p", vector_to_array("probability")[1])
    steps = IsotonicRegression(featuresCol="p", labelCol="label").fit(raw(hold).select("p", "label"))
    out = steps.transform(raw(assemble.transform(own)).select("doc_id", "held_out", "p"))
    # equal calibrated values keep the order of the trees
    out = out.select("doc_id", "held_out", F.expr("least(1D, greatest(0D, 0.999 * prediction + 0.001 * p))").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
