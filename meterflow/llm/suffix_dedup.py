"""Exact repeated-substring removal by a distributed enhanced suffix array.

Every window of ``length`` bytes is assigned to its smallest ``k``-byte string
(by hash), so equal windows meet under the same anchor.  A run of neighbouring
windows with one anchor is a *context* of at most ``2 * length - k`` bytes.

1. Contexts whose anchor occurs once can't repeat and go no further.
2. Equal contexts are leaves with the same label: all but the first repeat.
3. Distinct contexts of an anchor meet in one task, which sorts their suffixes,
   takes common-prefix lengths of neighbours and scans them with a stack.  An
   interval of the tree whose occurrences are preceded by different bytes is a
   maximal repeat; each of its occurrences but the first is reported with the
   longest such repeat.  Intervals that could be extended to the left are
   covered by the repeat that starts one byte earlier.
4. Anchors with more contexts than a task should hold are resolved by window
   hashes, aggregated before the shuffle.
5. Pieces that continue each other are chained into maximal repeat groups of
   any length, with all occurrences (:func:`repeat_groups`).

Documents are ordered by ``doc_id``; within one, by place.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from meterflow.llm.components import release, settle
from meterflow.llm.kernel import CODES, U64, _powers, anchored_segments, mix, text_buffers

LENGTH = 100
#: Bytes of an anchor string.
ANCHOR = 20
#: Contexts of one anchor that a single task resolves; beyond it, step 4.
HOT_CONTEXTS = 20_000
#: Bytes of a block by which occurrences meet the stretches that cover them.
BLOCK = 1024
#: Contexts that one task of step 3 holds on average.
TASK_CONTEXTS = 12_000


def _contexts(length: int):
    def run(batches):
        for b in batches:
            ids = np.asarray(b.column("doc_id"))
            for t, start, n, h, g in anchored_segments(*text_buffers(b.column("text")), length, ANCHOR):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(g.view(np.int64)), pa.array(ids[t]), pa.array(start), pa.array(n.astype(np.int32))],
                    ["h", "g", "doc", "start", "n"])
    return run


def _cut_out(length: int):
    """Bytes of the named contexts of each document; for hot anchors, two hashes of each window instead."""
    def run(batches):
        for b in batches:
            data, off = text_buffers(b.column("text"))
            want = b.column("want")
            row = np.repeat(np.arange(len(b)), np.asarray(want.value_lengths()))
            w = want.flatten()
            start, n, hot = (np.asarray(w.field(c)) for c in ("start", "n", "hot"))
            h = np.asarray(w.field("h"))
            ids = np.asarray(b.column("doc_id"))[row]
            at = off[row] + start
            cold = np.flatnonzero(~hot)
            parts = [data[a: a + c + length - 1].tobytes() for a, c in zip(at[cold].tolist(), n[cold].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[cold]), pa.nulls(len(cold), pa.int64()), pa.array(ids[cold]), pa.array(start[cold]),
                 pa.array(n[cold].astype(np.int32)), pa.array(parts, pa.binary())], ["h", "w", "doc", "start", "n", "ctx"])
            for lo in range(0, int(hot.sum()), 10_000):
                i = np.flatnonzero(hot)[lo: lo + 10_000]
                j = np.arange(int(n[i].sum())) - np.repeat(np.cumsum(n[i]) - n[i], n[i])
                i = np.repeat(i, n[i])
                first, second = _window_hashes(data, at[i] + j, length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), pa.array(ids[i]), pa.array(start[i] + j),
                     pa.nulls(len(i), pa.int32()), pa.nulls(len(i), pa.binary())], ["h", "w", "doc", "start", "n", "ctx"])
    return run


def _window_hashes(data, at, length):
    p, q = _powers(length)
    one, two = np.zeros(len(at), U64), np.zeros(len(at), U64)
    for i in range(length):
        v = CODES[data[at + i]]
        one += v * p[i]
        two += mix(v + U64(i)) * q[i]
    return mix(one), mix(two)


def _words(data: np.ndarray, at: np.ndarray, left: np.ndarray, n_words: int) -> np.ndarray:
    """``n_words`` big-endian 8-byte words from each place; bytes after the ``left`` remaining ones are 0."""
    i = np.arange(n_words * 8)
    out = np.empty((len(at), n_words), U64)
    for lo in range(0, len(at), 20_000):
        a, m = at[lo: lo + 20_000, None], left[lo: lo + 20_000, None]
        raw = data[np.minimum(a + i, len(data) - 1)]
        raw[i >= m] = 0
        out[lo: lo + 20_000] = raw.view(">u8")
    return out


def repeat_intervals(ctx: np.ndarray, off: np.ndarray, n: np.ndarray, rank0: np.ndarray, length: int):
    """Stack scan of the enhanced suffix array over contexts.

    ``ctx``/``off``: the contexts' bytes; ``n``: windows of each; ``rank0``:
    the order of each context's first window (windows follow by one).  Yields
    arrays (context, window, repeat length, context of the first occurrence,
    its window) of every occurrence but the first of a maximal repeat.
    """
    j = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    c = np.repeat(np.arange(len(n)), n)
    at = off[c] + j
    size = len(ctx)
    key = np.empty(len(at), U64)
    step, pos = 1 << 20, 0
    while pos < len(at):  # rolling hashes, block by block
        sl = slice(pos, pos + step)
        lo, hi = int(at[sl][0]), int(at[sl][-1]) + length
        p, q = _powers(hi - lo + 1)
        s = np.zeros(hi - lo + 1, U64)
        np.cumsum(CODES[ctx[lo:hi]] * p[: hi - lo], dtype=U64, out=s[1:])
        key[sl] = mix((s[at[sl] - lo + length] - s[at[sl] - lo]) * q[at[sl] - lo])
        pos += step
    o = np.argsort(key, kind="stable")
    new = np.ones(len(o), bool)
    new[1:] = key[o[1:]] != key[o[:-1]]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(o)))
    before = np.where(j > 0, ctx[np.maximum(at - 1, 0)].astype(np.int16), np.int16(-1))[o]
    low, high = np.minimum.reduceat(before, first), np.maximum.reduceat(before, first)
    keep = np.repeat((count > 1) & ((low < 0) | (low != high)), count)
    cls = np.repeat(np.arange(len(first)), count)[keep]
    leaf = o[keep]
    if not len(leaf):
        return
    left = (off[c + 1] - at)[leaf]
    rest = -(-(int(left.max()) - length) // 8)
    tail = _words(ctx, at[leaf] + length, left - length, max(rest, 1))
    s = np.lexsort((*(tail[:, i] for i in range(tail.shape[1] - 1, -1, -1)), cls))
    leaf, cls, left, tail = leaf[s], cls[s], left[s], tail[s]
    # common-prefix length of neighbours; the shared window itself is compared too
    diff = tail[1:] ^ tail[:-1]
    some = diff != 0
    word = np.where(some.any(axis=1), some.argmax(axis=1), tail.shape[1])
    x = diff[np.arange(len(diff)), np.minimum(word, tail.shape[1] - 1)]
    byte = np.zeros(len(x), np.int64)
    for b in range(7, 0, -1):
        byte += (x >> U64(64 - 8 * b)) == 0
    lcp = length + np.where(word < tail.shape[1], word * 8 + byte, tail.shape[1] * 8)
    lcp = np.minimum(lcp, np.minimum(left[1:], left[:-1]))
    head = _words(ctx, at[leaf], left, -(-length // 8))
    if length % 8:
        head[:, -1] >>= U64(8 * (8 - length % 8))
    lcp[(cls[1:] != cls[:-1]) | (head[1:] != head[:-1]).any(axis=1)] = 0

    rank = (rank0[c] + j)[leaf].tolist()
    prev = np.where(j > 0, ctx[np.maximum(at - 1, 0)].astype(np.int16), np.int16(-1))[leaf].tolist()
    reach, head_of = [0] * len(leaf), [0] * len(leaf)
    # a stack entry: depth, first leaf, byte before (-1: several), leaves without a repeat so far
    stack: list[list] = []
    for i, depth in enumerate([*lcp.tolist(), 0]):
        node = [1 << 60, i, prev[i], [i]]
        while stack and stack[-1][0] > depth:
            top = stack.pop()
            _merge(top, node, rank)
            _close(top, reach, head_of)
            node = top
        if depth >= length:
            if stack and stack[-1][0] == depth:
                _merge(stack[-1], node, rank)
            else:
                stack.append([depth, *node[1:]])
    reach = np.array(reach)
    hit = np.flatnonzero(reach)
    lead = np.array(head_of)[hit]
    yield c[leaf[hit]], j[leaf[hit]], reach[hit], c[leaf[lead]], j[leaf[lead]]


def _merge(into: list, node: list, rank: list) -> None:
    if rank[node[1]] < rank[into[1]]:
        into[1] = node[1]
    if into[2] != node[2]:
        into[2] = -1
    if len(node[3]) > len(into[3]):
        into[3], node[3] = node[3], into[3]
    into[3] += node[3]


def _close(node: list, reach: list, head_of: list) -> None:
    """Report a maximal repeat: every open leaf but the first occurrence gets this depth."""
    if node[2] == -1:
        for leaf in node[3]:
            if leaf != node[1]:
                reach[leaf], head_of[leaf] = node[0], node[1]
        node[3] = [node[1]]


def _scan(length: int):
    """A whole partition of contexts, in which the contexts of an anchor lie together."""
    def run(batches):
        held = [b for b in batches if len(b)]
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        ctx, off = text_buffers(t.column("ctx"))
        doc, start, n = (np.asarray(t.column(x)) for x in ("doc", "start", "n"))
        order = np.lexsort((start, doc))
        rank0 = np.empty(len(doc), np.int64)
        # the order of a window: documents one after the other, places within them
        same = np.zeros(len(doc), bool)
        same[1:] = doc[order[1:]] == doc[order[:-1]]
        run_id = np.cumsum(~same)
        base = np.zeros(run_id[-1] + 1, np.int64)
        span = np.zeros(run_id[-1] + 1, np.int64)
        np.maximum.at(span, run_id, start[order] + n[order])
        base[1:] = np.cumsum(span)[:-1]
        rank0[order] = base[run_id] + start[order]
        for c, j, reach, c0, j0 in repeat_intervals(ctx, off, n.astype(np.int64), rank0, length):
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[c]), pa.array(start[c] + j), pa.array(reach), pa.array(doc[c0]), pa.array(start[c0] + j0)],
                ["doc", "start", "size", "first_doc", "first_start"])
    return run


SPAN = "doc long, start long, size long, first_doc long, first_start long"


def _shared_contexts(docs: DataFrame, length: int) -> DataFrame:
    seg = settle(docs.mapInArrow(_contexts(length), "h long, g long, doc long, start long, n int"), "contexts")
    often = seg.groupBy("h").agg(F.count("*").alias("c"), (F.min("g") != F.max("g")).alias("several")).where("c > 1")
    often = settle(often.select("h", "several"), "often")  # a table of its own, so that the join can split hot anchors
    shared = settle(seg.join(often, "h"), "shared")
    release(seg, often)
    return shared


def _equal_contexts(shared: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Repeats among equal contexts, and the kinds of context with their first."""
    kind = shared.groupBy("h", "g").agg(F.min(F.struct("doc", "start")).alias("f"), F.count("*").alias("c"),
                                        F.max("n").alias("n"), F.max("several").alias("several"))
    kind = settle(kind, "kinds")
    more = (shared.join(kind.where("c > 1").select("h", "g", "f"), ["h", "g"]).where("doc <> f.doc OR start <> f.start")
            .select("doc", "start", (F.col("n") + length - 1).cast("long").alias("size"),
                    F.col("f.doc").alias("first_doc"), F.col("f.start").alias("first_start")))
    return settle(more, "equal"), kind


def _named_bytes(docs: DataFrame, want: DataFrame, length: int, hot_contexts: int) -> DataFrame:
    hot = want.groupBy("h").count().where(F.col("count") > hot_contexts).select("h", F.lit(True).alias("hot"))
    want = want.join(hot, "h", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    per = want.groupBy("doc").agg(F.collect_list(F.struct("h", "start", "n", "hot")).alias("want"))
    both = docs.join(per.withColumnRenamed("doc", "doc_id"), "doc_id").select("doc_id", "text", "want")
    return settle(both.mapInArrow(_cut_out(length), "h long, w long, doc long, start long, n int, ctx binary"), "bytes")


def repeats(docs: DataFrame, length: int = LENGTH, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """Repeated stretches of at least ``length`` bytes.

    Each row (``doc``, ``start``, ``size``, ``first_doc``, ``first_start``)
    says that ``size`` bytes of ``doc`` from ``start`` are an occurrence of
    the repeat that occurs first in ``first_doc`` at ``first_start``.  Rows
    with the same first occurrence and size are one group.  ``docs`` has
    distinct non-null ``doc_id`` and ``text``.  The result's ``scratch`` names
    the tables that it reads (:func:`release`).
    """
    shared = _shared_contexts(docs, length)
    equal, kind = _equal_contexts(shared, length)
    # the first of each kind where an anchor has several kinds
    want = kind.where("several").select("h", F.col("f.doc").alias("doc"), F.col("f.start").alias("start"), "n")
    raw = _named_bytes(docs, want, length, hot_contexts)
    release(shared, kind)
    cold, hot = raw.where("ctx IS NOT NULL"), raw.where("ctx IS NULL")
    tasks = max(1, cold.count() // TASK_CONTEXTS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    scanned = cold.select("h", "doc", "start", "n", "ctx").repartition(tasks, "h").mapInArrow(_scan(length), SPAN)
    least = hot.groupBy("h", "w").agg(F.min(F.struct("doc", "start")).alias("f"), F.count("*").alias("c")).where("c > 1")
    split = (hot.join(least, ["h", "w"]).where("doc <> f.doc OR start <> f.start")
             .select("doc", "start", F.lit(length).cast("long").alias("size"), F.col("f.doc").alias("first_doc"), F.col("f.start").alias("first_start")))
    out = equal.unionByName(scanned).unionByName(split)
    out.scratch = equal.scratch + raw.scratch
    return out


def _chained(pieces: DataFrame) -> DataFrame:
    """Pieces that touch or overlap at one shift from the same first text become one stretch."""
    lane = Window.partitionBy("doc", "first_doc", F.expr("start - first_start")).orderBy("start", "size")
    far = F.max(F.expr("start + size")).over(lane.rowsBetween(Window.unboundedPreceding, -1))
    part = F.sum(F.when(F.col("start") <= F.col("far"), 0).otherwise(1)).over(lane)
    return (pieces.withColumn("far", far).withColumn("part", part).groupBy("doc", "first_doc", F.expr("start - first_start").alias("shift"), "part")
            .agg(F.min("start").alias("start"), F.max(F.expr("start + size")).alias("end"))
            .select("doc", "start", F.expr("end - start AS size"), "first_doc", F.expr("start - shift AS first_start")))


def repeat_groups(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Maximal repeat groups with all their occurrences, the first included.

    Each row (``first_doc``, ``first_start``, ``size``, ``doc``, ``start``)
    is one occurrence of the stretch of ``size`` bytes that occurs first in
    ``first_doc`` at ``first_start``.  The pieces of :func:`repeats`, whatever
    their length, are chained into stretches of any length.  Occurrences
    inside a longer repeat's occurrence count too: they are found by following
    the longer repeat from its first text to its others, until nothing is
    new.  Where a stretch's middle also occurs in a still earlier text, the
    parts on both sides and the middle are groups of their own.  The result is
    as large as there are occurrences.  ``docs`` as in :func:`repeats`; texts
    without repeats and an empty table give no rows.
    """
    pieces = repeats(docs, length)
    runs = settle(_chained(pieces.distinct()), "stretches")
    release(pieces)
    group = ["first_doc", "first_start", "size"]
    found = settle(runs.select(*group).distinct().withColumns({"doc": F.col("first_doc"), "start": F.col("first_start")}), "firsts")
    over = runs.select(F.col("first_doc").alias("doc"), F.col("doc").alias("to"), F.expr("start - first_start AS shift"), F.col("first_start").alias("low"),
                       F.expr("first_start + size AS high"), F.expr(f"explode(sequence(first_start div {BLOCK}, (first_start + size - 1) div {BLOCK}))").alias("block"))
    new = found
    while not new.isEmpty():
        at = new.withColumn("block", F.expr(f"start div {BLOCK}"))
        more = (at.join(over, ["doc", "block"]).where("low <= start AND start + size <= high")
                .select(*group, F.col("to").alias("doc"), F.expr("start + shift AS start")).distinct())
        new = settle(more.join(found, [*group, "doc", "start"], "left_anti"), "occurrences")
        found = settle(found.unionByName(new), "found")
    return found


def _merged(starts: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Maximal removed runs; touching runs are one."""
    out: list[tuple[int, int]] = []
    for i in np.argsort(starts, kind="stable"):
        a, b = int(starts[i]), int(starts[i] + sizes[i])
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _apply(names: list[str], as_text: bool):
    """Remove the spans; with ``as_text``, a character cut by a span's edge stays whole."""
    def run(batches):
        for b in batches:
            data, off = text_buffers(b.column("text"))
            spans = b.column("spans")
            so = np.concatenate(([0], np.cumsum(np.asarray(spans.value_lengths().fill_null(0)))))
            flat = spans.flatten()
            starts, sizes = np.asarray(flat.field("start")), np.asarray(flat.field("size"))
            n, removed, runs, sha, kept_text = [], [], [], [], []
            for i in range(len(b)):
                t = data[off[i]: off[i + 1]]
                m = _merged(starts[so[i]: so[i + 1]], sizes[so[i]: so[i + 1]])
                if as_text:
                    m = [(x, y) for x, y in (_whole_characters(t, x, y) for x, y in m) if x < y]
                keep, at = [], 0
                for x, y in m:
                    keep.append(t[at:x])
                    at = y
                left = b"".join(k.tobytes() for k in [*keep, t[at:]])
                n.append(len(t))
                removed.append(len(t) - len(left))
                runs.append(len(m))
                if as_text:
                    kept_text.append(left.decode("utf-8", "replace") if m else None)
                else:
                    sha.append(hashlib.sha256(left).hexdigest())
            if as_text:
                cols = [b.column("row"), pa.array(kept_text, pa.string()), pa.array(removed, pa.int64())]
            else:
                cols = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha)]
            yield pa.RecordBatch.from_arrays(cols, names)
    return run


def _whole_characters(t: np.ndarray, x: int, y: int) -> tuple[int, int]:
    while x < y and t[x] & 0xC0 == 0x80:
        x += 1
    while y > x and y < len(t) and t[y] & 0xC0 == 0x80:
        y -= 1
    return x, y


def _source(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows with ``doc_id`` and ``text``, and one text for each usable id.

    An id with different texts has no defined order and takes no part.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct("*").alias("row"))
    named = rows.where("doc_id IS NOT NULL").select("doc_id", "text")
    ids = named.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select("doc_id")
    if ids.isEmpty():
        return rows, named
    twice = named.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("text").alias("t2"))
    return rows, named.join(ids, "doc_id", "left_anti").unionByName(twice.where("text = t2").select("doc_id", "text"))


def _with_spans(docs: DataFrame, length: int, keep: str) -> DataFrame:
    """Every row's ``doc_id``, its ``text`` or whole ``row`` (which holds the text), and its spans."""
    rows, use = _source(docs)
    rows = rows.select("doc_id", keep)  # the text is shuffled once
    pieces = repeats(use, length)
    spans = settle(pieces, "spans")
    release(pieces)
    per = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "size")).alias("spans"))
    return rows.join(per.withColumnRenamed("doc", "doc_id"), "doc_id", "left")


def repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Bytes of each row that a string of ``length`` bytes which also starts earlier covers.

    Returns ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256``.  A null text counts as empty; texts shorter than
    ``length`` keep every byte.  Rows with a null ``doc_id`` and rows that
    share an id but not a text take no part: nothing of them is removed.
    Repeated rows of one id and text are one document.  Other columns of
    ``docs`` are ignored; an empty table gives an empty result.
    """
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return _with_spans(docs, length, "text").select("doc_id", "text", "spans").mapInArrow(
        _apply(names, False), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def stage_suffix_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated stretches go from all but their first place; ``n_chars`` follows.

    Characters cut by a stretch's edge stay whole.  Documents of which only
    white space is left go.
    """
    kind = _with_spans(docs, LENGTH, "row").select("row", F.col("row.text").cast("string").alias("text"), "spans")
    schema = StructType([kind.schema["row"], StructField("kept", StringType()), StructField("removed", LongType())])
    out = kind.mapInArrow(_apply(["row", "kept", "removed"], True), schema)
    out = out.where("removed = 0 OR trim(kept) <> ''")
    cols = [F.coalesce("kept", F.col("row.text")).alias("text") if c == "text"
            else F.when(F.col("kept").isNull(), F.col("row.n_chars")).otherwise(F.length("kept")).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
            else F.col("row")[c].alias(c) for c in docs.columns]
    return out.select(cols)


def op3_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
