"""Benchmark decontamination by a distributed positional inverted index; DataFrame functions only.

1. Count the benchmark's terms over the whole corpus.
2. Every benchmark window (ten words in a row; a shorter item is one window)
   names its rarest terms.
3. Store the postings (term, document, position) of those terms.
4. Shift each posting by its term's place in the item and intersect: a
   document and a shift at which all rarest terms of a window meet is a
   candidate.
5. Candidates are compared word by word with the document itself.

The index folds case by ``lower``, which never separates words that are equal
after lower-casing A-Z; step 5 applies the exact rule.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.components import cut, remove
from meterflow.session import scratch_path

WINDOW = 10
#: Rarest terms a window is looked up by.
RAREST = 3
#: Term tables of up to this many rows are broadcast (a few tens of MB); larger ones join by shuffle.
BROADCAST_TERMS = 200_000
#: Item tables with up to this many words or windows in all are broadcast.
BROADCAST_ENTRIES = 1_000_000
DELIMITER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DELIMITER_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def _terms(c: Column) -> Column:
    """Words with case folded; a first or last empty string keeps its place and matches nothing."""
    return F.split(F.lower(c), DELIMITER)


def _small(terms: DataFrame) -> tuple[DataFrame, bool]:
    """The cut table, marked for broadcast where its counted size allows."""
    t = cut(terms)
    fits = t.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
    return (F.broadcast(t) if fits else t), fits


def _fitting(table: DataFrame, size: Column) -> DataFrame:
    """A benchmark-sized table, marked for broadcast where its counted entries allow."""
    t = cut(table)
    return F.broadcast(t) if (t.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_ENTRIES else t


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """Distinct item texts as exact words ``iw`` with key ``k`` and the ``ids`` (strings) that have them.

    Items with a null id, a null text or no words have no windows.
    """
    iw = F.filter(F.split(_ascii_lower(F.col("text").cast("string")), DELIMITER), lambda w: w != "")
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), iw.alias("iw"))
    return items.where("size(iw) > 0").groupBy("iw").agg(F.collect_set("item_id").alias("ids")).withColumn("k", F.md5(F.concat_ws(" ", "iw")))


def rarest_terms(docs: DataFrame, items: DataFrame, window: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """Rows (k, s, off, term): the rarest terms of each window that starts at word ``s`` of an item.

    Windows with a term that no document has are left out.
    """
    at = items.select("k", F.posexplode("iw").alias("off", "word")).select("k", "off", F.lower("word").alias("term"))
    vocab, fits = _small(at.select("term").distinct())
    corpus = docs.select(F.explode(_terms(F.col("text"))).alias("term"))
    if fits:
        corpus = corpus.join(vocab, "term", "left_semi")
    counts = corpus.groupBy("term").agg(F.count("*").alias("c")).join(vocab, "term", "left_semi")
    at = cut(at.join(counts, "term", "left").withColumn("c", F.coalesce("c", F.lit(0))))
    wins = items.select("k", F.size("iw").alias("n"), F.explode(F.sequence(F.lit(0), F.greatest(F.size("iw") - window, F.lit(0)))).alias("s"))
    per = (wins.select("k", "s", F.explode(F.sequence("s", F.least(F.col("s") + window, F.col("n")) - 1)).alias("off"))
           .join(at, ["k", "off"]))
    w = Window.partitionBy("k", "s").orderBy("c", "term", "off")
    return (per.withColumn("least", F.min("c").over(Window.partitionBy("k", "s"))).withColumn("rn", F.row_number().over(w))
            .where(f"least > 0 AND rn <= {int(rarest)}").select("k", "s", "off", "term"))


def write_postings(docs: DataFrame, terms: DataFrame, path: str | None = None) -> DataFrame:
    """The stored postings (term, rid, pos) of ``terms`` over all documents, in a fresh folder unless ``path`` names one."""
    named, _ = _small(terms.select("term").distinct())
    path = path or scratch_path(docs.sparkSession, "postings")
    docs.select("rid", F.posexplode(_terms(F.col("text"))).alias("pos", "term")).join(named, "term").write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def phrase_candidates(postings: DataFrame, sel: DataFrame) -> DataFrame:
    """Rows (rid, k, diag, starts): windows of item ``k`` whose rarest terms all meet at shift ``diag``."""
    places = sel.select("k", "off", "term").distinct()
    met = (postings.join(places, "term").select("rid", "k", "off", (F.col("pos") - F.col("off")).alias("diag"))
           .groupBy("rid", "k", "diag").agg(F.collect_set("off").alias("got")))
    needs = (sel.groupBy("k", "s").agg(F.collect_set("off").alias("req"))
             .groupBy("k").agg(F.collect_list(F.struct("s", "req")).alias("wins"), F.min(F.size("req")).alias("few")))
    found = met.join(_fitting(needs, F.size("wins")), "k").where("size(got) >= few").withColumn("starts", F.expr(
        "transform(filter(wins, w -> diag + w.s >= 0 AND size(array_except(w.req, got)) = 0), w -> w.s)"))
    return found.where("size(starts) > 0").select("rid", "k", "diag", "starts")


def proximity_matches(docs: DataFrame, benchmark: DataFrame, span: int = 50, window: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """Documents that have all words of a window within ``span`` words of its lead term, in any order.

    The lead is one of the window's rarest terms.  These only find candidate
    places; there, all words of the window are compared with the document.
    Returns distinct ``doc_id``, ``item_id`` (string).  Null texts and ids
    match nothing; empty tables give an empty result.
    """
    docs, items = _rows(docs), cut(benchmark_items(benchmark))
    sel = cut(rarest_terms(docs, items, window, rarest))
    post = write_postings(docs, sel).withColumn("b", F.expr(f"pos div {int(span)}"))
    size = sel.groupBy("k", "s").agg(F.countDistinct("term").alias("n"), F.min(F.struct("term", "off")).alias("m"))
    lead = size.select("k", "s", "n", F.col("m.term").alias("term"))
    base = post.join(lead, "term").select("rid", "k", "s", "n", F.col("pos").alias("at"), F.explode(F.expr("array(b - 1, b, b + 1)")).alias("b"))
    other = post.join(sel.select("k", "s", "term").distinct(), "term").select("rid", "k", "s", "term", "pos", "b")
    near = (base.join(other, ["rid", "k", "s", "b"]).where(f"abs(pos - at) <= {int(span)}")
            .groupBy("rid", "k", "s", "n", "at").agg(F.countDistinct("term").alias("c")).where("c = n").select("rid", "k", "s", "at"))
    need = near.join(items.select("k", "iw"), "k").select("rid", "k", "at", F.expr(f"array_distinct(slice(iw, s + 1, {int(window)}))").alias("need"))
    words = docs.select("rid", "doc_id", F.split(_ascii_lower(F.col("text")), DELIMITER).alias("w"))
    around = f"slice(w, greatest(at - {int(span)}, 0) + 1, at + {int(span)} - greatest(at - {int(span)}, 0) + 1)"
    hit = need.join(words, "rid").where(f"size(array_except(need, {around})) = 0").select("doc_id", "k").distinct()
    return hit.join(items.select("k", F.explode("ids").alias("item_id")), "k").select("doc_id", "item_id").distinct()


def _rows(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and a join key for every row."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.withColumn("rid", F.coalesce("doc_id", F.xxhash64("text")))


def _candidates(docs: DataFrame, items: DataFrame, window: int, rarest: int, path: str | None = None) -> DataFrame:
    """For each document (``rid``) with phrase candidates, all of them as the list ``c``."""
    sel = cut(rarest_terms(docs, items, window, rarest))
    found = phrase_candidates(write_postings(docs, sel, path), sel)
    return found.join(_fitting(items, F.size("iw")), "k").groupBy("rid").agg(F.collect_list(F.struct("diag", "starts", "iw", "ids")).alias("c"))


def _judged(docs: DataFrame, text: Column, window: int, kept: list[str]) -> DataFrame:
    """Compare ``text`` with the candidates ``c``, word by word; adds the counts to the columns ``kept``."""
    size = f"least({int(window)}, size(x.iw))"
    exact = F.split(_ascii_lower(text), DELIMITER)
    # one-element arrays bind a value once for the lambda inside
    out = docs.select(
        *kept, F.split(text, DELIMITER_ANY_CASE).alias("raw"),
        F.when(F.col("c").isNotNull(), F.array(F.struct(exact.alias("w"), F.col("c").alias("c")))).alias("z"))
    out = out.withColumn("v", F.expr(f"""transform(z, z -> filter(transform(z.c, x -> named_struct('ids', x.ids, 'diag', x.diag, 'len', {size},
        'ok', filter(x.starts, s -> slice(z.w, x.diag + s + 1, {size}) = slice(x.iw, s + 1, {size})))), y -> size(y.ok) > 0))"""))
    out = out.withColumn("r", F.expr("""transform(v, v -> named_struct(
        'hit', size(array_distinct(flatten(transform(v, y -> flatten(transform(y.ok, s -> sequence(y.diag + s, y.diag + s + y.len - 1))))))),
        'items', array_sort(array_distinct(flatten(transform(v, y -> y.ids))))))[0]"""))
    n = "size(raw) - IF(raw[0] = '', 1, 0) - IF(size(raw) > 1 AND raw[size(raw) - 1] = '', 1, 0)"
    return out.select(*kept, F.expr(f"CASE WHEN raw IS NULL THEN 0 ELSE {n} END").cast("long").alias("n_words"),
                      F.coalesce(F.col("r.hit"), F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce(F.col("r.items"), F.array().cast("array<string>")).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """Words of each document that lie in an occurrence of a benchmark window.

    Returns, for every row of ``docs`` (``doc_id``, ``text``; other columns
    are ignored), ``doc_id``, ``n_words``, ``n_hit``, ``n_items``,
    ``items_sha256``, ``contaminated`` and the sorted ``items``.  A null or
    empty text has no words.  Repeated rows and rows with a null ``doc_id``
    are each judged by their own text.  Empty tables give no hits or no rows.
    """
    docs, items = _rows(docs), cut(benchmark_items(benchmark))
    per = _candidates(docs, items, window, rarest)
    docs = docs.select("rid", "doc_id", "text")  # the text is shuffled once
    out = _judged(docs.join(per, "rid", "left"), F.col("text"), window, ["doc_id"])
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "items")


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """The rows of ``docs``, as they are, whose text holds no benchmark window.

    Only documents with candidates are read word by word, and only the keys
    of contaminated ones (row key and hash of the text, so that rows which
    share an id are each judged by their own text) meet all rows.  Null and
    empty texts are clean; repeated rows stay or go together; columns of any
    name stay; empty tables give all rows or none.  The postings are deleted
    before the result is returned.
    """
    rows, items = _rows(docs), cut(benchmark_items(benchmark))
    path = scratch_path(docs.sparkSession, "postings")
    per = _fitting(_candidates(rows, items, window, rarest, path), F.aggregate("c", F.lit(0), lambda n, x: n + F.size(x["iw"])))
    judged = _judged(rows.join(per, "rid").withColumn("h", F.xxhash64("text")), F.col("text"), window, ["rid", "h"])
    bad = cut(judged.where("n_hit > 0").select("rid", "h").distinct())
    bad = F.broadcast(bad) if bad.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS else bad
    remove(docs.sparkSession, path)
    rid, text = F.coalesce(docs["doc_id"].cast("long"), F.xxhash64(docs["text"].cast("string"))), docs["text"].cast("string")
    own = docs.select(F.struct("*").alias("row"), rid.alias("rid"), F.xxhash64(text).alias("h"))
    return own.join(bad, ["rid", "h"], "left_anti").select("row.*")


def stage_decontaminate(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with a benchmark window go, all others stay as they are (:func:`clean_documents`)."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("items")


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
ORACLE_OP10 = f"""
WITH b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
dw AS (
  SELECT doc_id, l, s, array_to_string(w[s:s + l - 1], ' ') AS g
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l)),
m AS (SELECT doc_id, item_id, s, dw.l FROM dw JOIN bw ON dw.l = bw.l AND dw.g = bw.g),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM m) GROUP BY doc_id),
i AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""
