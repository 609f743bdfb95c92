"""N-gram Jaccard join: rare-first prefix filtering, verified once per pair.

Documents are sets of distinct word shingles (64-bit hashes).  Two documents
link when ``100 * |A n B| >= percent * |A u B|``.

1. Documents with equal sets collapse to one class (its smallest id).
2. A fixed-size count sketch of all shingles gives the rare-first order.
3. Each class emits only the rarest shingles of its prefix; classes that
   share one become candidates if length, position and suffix allow it.
4. Candidates are first met through one pivot per prefix shingle, which joins
   large groups of near copies with a linear number of pairs.  Then every
   candidate pair whose two ends are still in different components is met,
   so no link between components is lost and pairs inside one are not
   spelled out.  Each pair is verified once, on the whole texts: what the
   first pass compared is taken out of the second.
"""

from __future__ import annotations

import string
import zlib
from hashlib import blake2b
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark import TaskContext

from meterflow.llm.components import connected_components, cut, release, settle
from meterflow.llm.kernel import pieces, shingle_sets, text_buffers

#: log2 of the sketch's counters (2**20 counters of 4 bytes: 4 MB, whatever the corpus).
SKETCH_BITS = 20
_CHUNKS = 64
#: Bins of the suffix filter.
_BINS = 64


def _sizes(batch, width):
    return shingle_sets(*text_buffers(batch.column("text")), width)


def _scan(width: int):
    """One pass: set size and fingerprint of each row, and the task's sketch."""
    def run(batches):
        total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for b in (piece for whole in batches for piece in pieces(whole)):
            n, fp = [], []
            for s in _sizes(b, width):
                n.append(len(s))
                fp.append(blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                if len(s):
                    np.add.at(total, (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
            k = len(n)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.nulls(k, pa.int32()),
                 pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], ["doc_id", "n", "fp", "chunk", "part", "counts"])
        if total.any():
            parts = [zlib.compress(c.tobytes(), 1) for c in np.split(total, _CHUNKS)]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(_CHUNKS, pa.int64()), pa.nulls(_CHUNKS, pa.int64()), pa.nulls(_CHUNKS, pa.binary()),
                 pa.array(range(_CHUNKS), pa.int32()), pa.array([TaskContext.get().partitionId()] * _CHUNKS, pa.int32()),
                 pa.array(parts, pa.binary())], ["doc_id", "n", "fp", "chunk", "part", "counts"])
    return run


def _add_counts(key, t):
    total = np.zeros((1 << SKETCH_BITS) // _CHUNKS, dtype=np.int64)
    for c in t.column("counts"):
        total += np.frombuffer(zlib.decompress(c.as_py()), dtype=np.int64)
    return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()),
                     "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def _sketch(scan: DataFrame) -> bytes:
    """Sum the tasks' sketches in two levels; 4 MB reach the driver, at any input size."""
    parts = scan.where("chunk IS NOT NULL").select("chunk", "part", "counts")
    level = max(1, isqrt(1 + (parts.agg(F.max("part")).first()[0] or 0)))
    summed = parts.groupBy("chunk", F.expr(f"part % {level}")).applyInArrow(
        _add_counts, "chunk int, counts binary")
    summed = summed.groupBy("chunk").applyInArrow(_add_counts, "chunk int, counts binary")
    out = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
    width = len(out) // _CHUNKS
    for r in summed.toLocalIterator():
        c = np.frombuffer(zlib.decompress(r["counts"]), dtype=np.int64)
        out[r["chunk"] * width: (r["chunk"] + 1) * width] = np.minimum(c, 2**32 - 1)
    return out.tobytes()


def _prefixes(width: int, percent: int, sketch):
    """Rare-first prefix, length of its indexing part, and bin counts of each set."""
    def run(batches):
        counts = np.frombuffer(sketch.value, dtype=np.uint32)
        for b in (piece for whole in batches for piece in pieces(whole)):
            n, pre, idx, bins = [], [], [], []
            for s in _sizes(b, width):
                k = len(s)
                c = counts[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                p = k - (percent * k + 99) // 100 + 1 if k else 0
                if p < k:  # only the p rarest need sorting
                    near = np.flatnonzero(c <= np.partition(c, p - 1)[p - 1])
                else:
                    near = np.arange(k)
                o = near[np.lexsort((s[near], c[near]))][:p]
                n.append(k)
                pre.append(s[o].view(np.int64))
                idx.append(k - -(-2 * percent * k // (100 + percent)) + 1)
                bins.append(np.minimum(np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=_BINS), 65535))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(pre, pa.list_(pa.int64())), pa.array(idx, pa.int64()),
                 pa.array(bins, pa.list_(pa.int32()))], ["doc_id", "n", "prefix", "idx", "bins"])
    return run


def _verify(width: int, percent: int):
    def run(batches):
        for b in (piece for whole in batches for half in pieces(whole, "ta") for piece in pieces(half, "tb")):
            ok = []
            for x, y in zip(shingle_sets(*text_buffers(b.column("ta")), width), shingle_sets(*text_buffers(b.column("tb")), width)):
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                inter = int((both[1:] == both[:-1]).sum())
                ok.append(100 * inter >= percent * (len(x) + len(y) - inter) and inter > 0)
            keep = pa.array(ok, pa.bool_())
            yield b.select(["a", "b"]).filter(keep)
    return run


def _least_overlap(na: str, nb: str, percent: int) -> str:
    """Smallest intersection two sets of these sizes need (rounded up)."""
    return f"(({percent} * ({na} + {nb}) + {99 + percent}) div {100 + percent})"


def _allowed(percent: int) -> str:
    """Length and position filter for the ordered ends x (shorter) and y of a shared prefix shingle."""
    return (f"100 * x.n >= {percent} * y.n AND x.pos < x.idx AND "
            f"1 + least(x.n - x.pos - 1, y.n - y.pos - 1) >= {_least_overlap('x.n', 'y.n', percent)}")


def _link(pairs: DataFrame, info: DataFrame, docs: DataFrame, width: int, percent: int,
          done: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Verified links among candidate pairs (a < b) that are not ``done``, and the pairs compared: suffix filter, then the whole texts."""
    bins = info.select("doc_id", "n", "bins")
    pairs = pairs.distinct()
    if done is not None:
        pairs = pairs.join(done, ["a", "b"], "left_anti")
    p = (pairs.join(bins.toDF("a", "na", "ba"), "a").join(bins.toDF("b", "nb", "bb"), "b")
         .where(f"aggregate(zip_with(ba, bb, (x, y) -> least(x, y)), 0, (s, x) -> s + x) >= {_least_overlap('na', 'nb', percent)}"
                " OR greatest(na, nb) > 65535").select("a", "b"))
    p = settle(p.distinct(), "pairs")
    need = p.select("a").union(p.select("b")).toDF("doc_id").distinct()
    # one plan at every size: small inputs are not broadcast either
    texts = docs.join(need.hint("merge"), "doc_id", "left_semi").distinct()
    side = p.join(texts.toDF("a", "ta").hint("merge"), "a")
    both = side.join(texts.toDF("b", "tb").hint("merge"), "b").select("a", "b", "ta", "tb")
    return settle(both.mapInArrow(_verify(width, percent), "a long, b long").distinct(), "links"), p


def _star(shared: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of each prefix shingle's pivot with its other members."""
    ends = shared.withColumn("me", F.struct("pos", "n", "idx", "doc_id")).where("doc_id <> pv.doc_id")
    first = "(pv.n < me.n OR (pv.n = me.n AND pv.doc_id < me.doc_id))"
    return (ends.select(F.expr(f"IF({first}, pv, me)").alias("x"), F.expr(f"IF({first}, me, pv)").alias("y"))
            .where(_allowed(percent)).select(F.expr("least(x.doc_id, y.doc_id) AS a"), F.expr("greatest(x.doc_id, y.doc_id) AS b")))


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, count_links: bool = False) -> DataFrame:
    """Set size and component of every row of ``docs`` (``doc_id``, ``text``; other columns are ignored).

    Returns ``doc_id``, ``n_shingles``, ``component_id``.  A null or wordless
    text has an empty set, links with nothing and is its own component.  A
    null ``doc_id`` gives a null component and links with nothing.  Rows that
    repeat a ``doc_id`` count as one document with the union of their links;
    each keeps its own row.  An empty table gives an empty result.

    With ``count_links``, every candidate pair is verified, also those inside
    one component, and ``n_links`` is added: the documents that a row's
    document links with, equal ones included.  A group of near copies then
    costs a number of pairs quadratic in its distinct texts.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scan = settle(docs.mapInArrow(_scan(width), "doc_id long, n long, fp binary, chunk int, part int, counts binary"), "sets")
    rows = scan.where("chunk IS NULL").select("doc_id", "n", "fp")
    classes = rows.where("fp IS NOT NULL AND doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep"))
    reps = classes.select(F.col("rep").alias("doc_id")).distinct()

    sketch = spark.sparkContext.broadcast(_sketch(scan))
    info = docs.where("doc_id IS NOT NULL").mapInArrow(
        _prefixes(width, percent, sketch), "doc_id long, n long, prefix array<long>, idx long, bins array<int>")
    info = settle(info.where("n > 0").join(reps, "doc_id", "left_semi").distinct(), "prefixes")

    post = info.select("doc_id", "n", "idx", F.posexplode("prefix").alias("pos", "gram"))
    # the pivot of a prefix shingle is the member that has it earliest
    pivot = (post.groupBy("gram").agg(F.min(F.struct("pos", "n", "idx", "doc_id")).alias("pv"), F.count("*").alias("c"))
             .where("c > 1").drop("c"))
    pivot = settle(pivot, "pivots")  # a table of its own, so that the join can split hot shingles
    shared = settle(post.join(pivot.hint("merge"), "gram"), "shared-grams")
    links = first = done = None
    if not count_links:
        first, done = _link(_star(shared, percent), info, docs, width, percent)
        links = first
        comp = cut(connected_components(links))

    # The rest: pairs whose ends are in different components.  Equal (shingle, size, place) cells meet first,
    # so that pairs the filters rule out, or that lie inside one component, are never spelled out.
    # To count links, each document counts as a component of its own.
    if count_links:
        own = shared.drop("pv").withColumn("component", F.col("doc_id"))
    else:
        own = shared.drop("pv").join(comp.toDF("doc_id", "component"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    own = cut(own)
    cell = own.groupBy("gram", "n", "idx", "pos").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    some = own.groupBy("gram").agg(F.min("component").alias("l"), F.max("component").alias("h")).where("l <> h").select("gram")
    cell = cell.join(some, "gram", "left_semi")
    pairs = (cell.alias("x").join(cell.alias("y"), F.expr(
        f"x.gram = y.gram AND (x.n < y.n OR x.n = y.n) AND {_allowed(percent)} AND NOT (x.lo = x.hi AND y.lo = y.hi AND x.lo = y.lo)"))
        .select("x.gram", "x.n", F.expr("x.pos AS p"), F.expr("y.n AS n2"), F.expr("y.pos AS p2")))
    left = own.select("gram", "n", F.col("pos").alias("p"), F.col("doc_id").alias("a"), F.col("component").alias("ca"))
    right = own.select("gram", F.col("n").alias("n2"), F.col("pos").alias("p2"), F.col("doc_id").alias("b"), F.col("component").alias("cb"))
    rest = (pairs.join(left, ["gram", "n", "p"]).join(right, ["gram", "n2", "p2"]).where("ca <> cb")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    more, compared = _link(rest, info, docs, width, percent, done)
    links = links.union(more) if links is not None else more
    comp = connected_components(links)

    release(info, pivot, shared, compared, *([] if count_links else [first, done, more]))
    named = classes.join(comp.toDF("rep", "component"), "rep", "left").select("fp", "rep", F.coalesce("component", "rep").alias("component_id"))
    if count_links:
        size = cut(rows.where("doc_id IS NOT NULL").join(classes, "fp").groupBy("rep").agg(F.countDistinct("doc_id").alias("m")))
        both = links.union(links.select("b", "a")).toDF("rep", "other").distinct()
        linked = both.join(size.toDF("other", "om"), "other").groupBy("rep").agg(F.sum("om").alias("far"))
        n_links = size.join(linked, "rep", "left").select("rep", (F.col("m") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"))
        named = named.join(n_links, "rep", "left")
    return (rows.join(named, "fp", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.expr("CASE WHEN doc_id IS NOT NULL THEN coalesce(component_id, doc_id) END").alias("component_id"),
                    *([F.expr("CASE WHEN doc_id IS NOT NULL THEN coalesce(n_links, 0L) ELSE 0L END").alias("n_links")] if count_links else [])))


def stage_jaccard(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component (five words, 0.8) the document with the smallest id stays.

    A repeated row of the kept id stays as it is, and so does a null id.
    """
    comp = jaccard_components(docs, 5, 80)
    kept = comp.where("doc_id = component_id").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").select(docs.columns)
    return named.unionByName(docs.where("doc_id IS NULL"))


def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), 3, 90)


ORACLE_OP1 = f"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(CASE WHEN len(w) >= 3 THEN array_to_string(w[i:i + 2], ' ') ELSE array_to_string(w, ' ') END) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM w UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM w JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)
"""
