"""Near-duplicate vectors by product quantisation.

1. Equal vectors collapse to one class with a count.
2. A coarse quantiser (inverted lists) and residual subspace codes are fitted
   on a bounded sample; every class is then indexed.
3. A query probes the lists that a near vector may lie in: the cap of vectors
   near the query must reach across the border of the two cells, and as close
   to the list's centroid as the list's farthest vector lies.  What fails
   either is not near, so probing loses nothing.  Two lists meet once, from
   the lower one, and a query is sent once for many lists.
4. In a list, codes are looked up in the codebooks once, and one matrix product
   gives the distances of all queries to all coded vectors.  A coded vector is
   off by its known coding error at most, so what lies beyond the threshold
   plus that error is ruled out without loss.
5. The rest is judged by the exact cosine.  Tasks return counts of links and a
   spanning forest of them, never all pairs.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.llm.components import connected_components, cut, release, settle

#: Vectors that the quantisers are fitted on, at most (smallest hash of the id).
SAMPLE = 20_000
#: Vectors per list on average, and lists at most.
PER_LIST, MAX_LISTS = 256, 1024
#: Dimensions of a subspace and centroids in each.
SUB_DIMS, SUB_CENTROIDS = 4, 256
#: A vector is sent to about so many task groups, as long as they hold no more than BLOCK_BYTES of vectors on a side.
COPIES, LEAST_BLOCK, BLOCK_BYTES = 8, 2048, 32 << 20
#: Distances worked on at once.
CELLS = 1 << 22


def _kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        a = _nearest(x, c)
        n = np.bincount(a, minlength=k)
        s = np.zeros_like(c)
        np.add.at(s, a, x)
        c[n > 0] = s[n > 0] / n[n > 0, None]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c * c).sum(1) / 2
    return np.concatenate([(half - x[i: i + 4096] @ c.T).argmin(1) for i in range(0, len(x), 4096)]) if len(x) else np.empty(0, np.int64)


class Quantiser:
    """Coarse centroids and one codebook for each run of ``SUB_DIMS`` dimensions of the residual."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.coarse = _kmeans(sample, min(lists, len(sample)), 10, 1)
        rest = sample - self.coarse[_nearest(sample, self.coarse)]
        d = sample.shape[1]
        self.cuts = [slice(i, min(i + SUB_DIMS, d)) for i in range(0, d, SUB_DIMS)]
        self.books = [_kmeans(rest[:, s], min(SUB_CENTROIDS, len(rest)), 6, 2 + i) for i, s in enumerate(self.cuts)]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, code and coding error of unit vectors."""
        a = _nearest(x, self.coarse)
        rest = x - self.coarse[a]
        code = np.stack([_nearest(rest[:, s], b) for s, b in zip(self.cuts, self.books)], 1).astype(np.uint8)
        for i, (s, b) in enumerate(zip(self.cuts, self.books)):
            rest[:, s] -= b[code[:, i]]
        return a, code, np.sqrt((rest * rest).sum(1))

    def probes(self, x: np.ndarray, own: np.ndarray, lists: np.ndarray, least: np.ndarray, cosine: float) -> np.ndarray:
        """Which of ``lists`` unit vectors of the lists ``own`` probe: all that hold a near one, whatever the data's shape.

        ``least``: smallest product of a list's centroid with a vector of that list, for each of ``lists``.
        """
        c, size = self.coarse[lists], (self.coarse * self.coarse).sum(1)
        gap = np.maximum(size[:, None] - 2 * self.coarse @ c.T + size[lists], 0)
        out = np.empty((len(x), len(lists)), bool)
        for i in range(0, len(x), 1024):
            q, o = x[i: i + 1024], own[i: i + 1024]
            at, mine = q @ c.T, (q * self.coarse[o]).sum(1)[:, None]
            border = _highest(at - mine, gap[o], cosine) >= (size[lists] - size[o][:, None]) / 2 - 1e-6
            out[i: i + 1024] = border & (_highest(at, size[lists], cosine) >= least - 1e-6)
        return out

    def lookup(self, which: int, code: np.ndarray, err: np.ndarray, reach: float) -> np.ndarray:
        """Rows for coded vectors of one list: the product with a unit query and a 1 is negative only beyond ``reach`` and the coding error."""
        x = np.concatenate([b[code[:, i]] for i, b in enumerate(self.books)], 1) + self.coarse[which]
        norm = (x * x).sum(1)
        least = (1 + norm - (reach + err + 1e-6) ** 2) / 2
        least -= (x.shape[1] + 8) * 2.0 ** -23 * (np.sqrt(norm) + np.abs(least))  # 32-bit rounding of the product
        return np.concatenate((x, -least[:, None]), 1).astype(np.float32)


def _highest(dot: np.ndarray, square: np.ndarray, cosine: float) -> np.ndarray:
    """Largest product with w that a unit vector of cosine ``cosine`` or more to q has, from q's product with w and w's squared length."""
    rim = cosine * dot + np.sqrt(max(1 - cosine * cosine, 0) * np.maximum(square - dot * dot, 0))
    return np.where(dot >= cosine * np.sqrt(square), np.sqrt(square), rim)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def _matrix(col, dim: int) -> np.ndarray:
    return np.asarray(col.combine_chunks().flatten() if isinstance(col, pa.ChunkedArray) else col.flatten(), np.float64).reshape(-1, dim)


def _bytes(x: np.ndarray) -> pa.Array:
    """Rows as binary values."""
    width = x.shape[1] * x.itemsize
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(np.arange(0, len(x) * width + 1, width, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(x))])


def _rows(col, kind) -> np.ndarray:
    """Rows from binary values of one length."""
    return np.frombuffer(b"".join(col.to_pylist()), kind).reshape(len(col), -1)


def _index(shared, dim: int, kind: str):
    def run(batches):
        z = shared.value
        for b in batches:
            if not len(b):
                continue
            v = _matrix(b.column("v"), dim)
            x = _unit(v)
            a, code, err = z.encode(x)
            yield pa.RecordBatch.from_arrays(
                [b.column("cid"), b.column("m"), _bytes(v.astype(kind)), pa.array(a.astype(np.int32)), _bytes(code), pa.array(err),
                 pa.array((x * z.coarse[a]).sum(1))], ["cid", "m", "v", "list", "code", "err", "dot"])
    return run


def _ask(shared, groups: np.ndarray, least: np.ndarray, kind: str, cosine: float):
    """Adds to each vector its list's group and the groups that hold a list it probes; ``groups`` and ``least`` are those of the lists."""
    lists = np.flatnonzero(groups >= 0)  # a list may be empty

    def run(batches):
        for b in batches:
            if not len(b):
                continue
            own = np.asarray(b.column("list"))
            p = shared.value.probes(_unit(_rows(b.column("v"), kind).astype(np.float64)), own, lists, least[lists], cosine) & (lists >= own[:, None])
            hit = np.zeros((len(own), groups.max() + 1), bool)
            q, j = np.nonzero(p)
            hit[q, groups[lists[j]]] = True
            asked = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(hit.sum(1)))).astype(np.int32), np.nonzero(hit)[1].astype(np.int32))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in ("cid", "m", "v", "list", "code", "err")), pa.array(groups[own].astype(np.int32)), asked],
                                             ["cid", "m", "v", "list", "code", "err", "group", "groups"])
    return run


def _search(shared, least: np.ndarray, kind: str, cosine: float):
    def run(q, i):
        if not q.num_rows or not i.num_rows:
            return pa.table({"cid": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        z, reach = shared.value, float(np.sqrt(max(2 - 2 * cosine, 0)))
        xq, xi = (_unit(_rows(t.column("v"), kind).astype(np.float64)) for t in (q, i))
        iq, ii = np.asarray(q.column("cid")), np.asarray(i.column("cid"))
        mq, mi = np.asarray(q.column("m")), np.asarray(i.column("m"))
        own, held = np.asarray(q.column("list")), np.asarray(i.column("list"))
        code, err = _rows(i.column("code"), np.uint8), np.asarray(i.column("err"))
        lists = np.unique(held)
        asked = z.probes(xq, own, lists, least[lists], cosine) & (lists >= own[:, None])
        ask = np.concatenate((xq, np.ones((len(xq), 1))), 1).astype(np.float32)
        nq, ni = np.zeros(len(iq), np.int64), np.zeros(len(ii), np.int64)
        ids, node = np.unique(np.concatenate((iq, ii)), return_inverse=True)
        root = np.arange(len(ids))  # smallest id of each part of the group
        for j, which in enumerate(lists):
            at, asker = np.flatnonzero(held == which), np.flatnonzero(asked[:, j])
            coded = z.lookup(which, code[at], err[at], reach).T
            step, exact = max(CELLS // len(at), 1), max(CELLS // xq.shape[1], 1)
            for lo in range(0, len(asker), step):
                some = asker[lo: lo + step]
                s, t = np.divmod(np.flatnonzero(ask[some] @ coded >= 0), len(at))
                for k in range(0, len(s), exact):  # exact cosine of the candidates
                    u, v = some[s[k: k + exact]], at[t[k: k + exact]]
                    ok = ((xq[u] * xi[v]).sum(1) >= cosine) & (iq[u] != ii[v])
                    u, v = u[ok], v[ok]
                    np.add.at(nq, u, mi[v])
                    once = own[u] != which  # inside a list, each end asks for the other
                    np.add.at(ni, v[once], mq[u[once]])
                    root = _joined(root, root[node[u]], root[node[len(iq) + v]])
        hits = [(iq[nq > 0], nq[nq > 0]), (ii[ni > 0], ni[ni > 0])]
        far_end = np.flatnonzero(root != np.arange(len(ids)))
        cid = np.concatenate([h[0] for h in hits] + [ids[far_end]])
        n = np.concatenate([h[1] for h in hits] + [np.zeros(len(far_end), np.int64)])
        return pa.table({"cid": pa.array(cid), "n": pa.array(n), "root": pa.array(np.concatenate([h[0] for h in hits] + [ids[root[far_end]]]))})
    return run


def _joined(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest node of each part after its parts ``x`` and ``y`` are joined."""
    if not len(x):
        return root
    part = np.arange(len(root))
    while True:
        low = part.copy()
        np.minimum.at(low, x, part[y])
        np.minimum.at(low, y, part[x])
        low = low[low]
        if (low == part).all():
            return part[root]
        part = low


def usable() -> str:
    """SQL condition for a vector that can link: no null or non-finite part, not zero."""
    return ("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
            " AND exists(v, x -> x <> 0)")


def _block(n: int, dim: int) -> int:
    """Vectors of a group of lists, and queries, that one task group holds on average."""
    return min(max(n // COPIES, LEAST_BLOCK), max(BLOCK_BYTES // (8 * dim), 256))


def _found(classes: DataFrame, dim: int, cosine: float, kind: str) -> DataFrame:
    """Link counts and spanning forest (``cid``, ``n``, ``root``) of the classes, all of length ``dim``; ``kind`` holds their numbers without loss."""
    n = classes.count()
    block = _block(n, dim)
    sample = classes.orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE).select("v").toArrow().column("v")
    z = classes.sparkSession.sparkContext.broadcast(Quantiser(_unit(_matrix(sample, dim)), int(min(max(n // PER_LIST, 1), MAX_LISTS))))
    coded = settle(classes.mapInArrow(_index(z, dim, kind), "cid long, m long, v binary, list int, code binary, err double, dot double"), "pq-codes")
    groups, least, held_by = np.full(len(z.value.coarse), -1), np.full(len(z.value.coarse), np.inf), 0
    for r in sorted(coded.groupBy("list").agg(F.count("*").alias("n"), F.min("dot").alias("least")).collect()):  # a row for each list, MAX_LISTS at most
        same = held_by + r["n"] <= block  # lists in a row share a group; a long list is one of its own
        groups[r["list"]] = max(groups.max() + (not same), 0)
        least[r["list"]] = r["least"]
        held_by = r["n"] + (held_by if same else 0)
    index = settle(coded.mapInArrow(_ask(z, groups, least, kind, cosine),
                                    "cid long, m long, v binary, list int, code binary, err double, group int, groups array<int>"), "pq-index")
    release(coded)
    size = index.groupBy("group").agg(F.ceil(F.count("*") / block).cast("int").alias("nb"))
    load = index.select(F.explode("groups").alias("group")).groupBy("group").agg(F.ceil(F.count("*") / block).cast("int").alias("nq"))
    plan = F.broadcast(cut(size.join(load, "group")))
    asked = (index.select("cid", "m", "v", "list", F.explode("groups").alias("group")).join(plan, "group")
             .select("cid", "m", "v", "list", "group", F.expr("pmod(xxhash64(cid), nq)").alias("qb"), F.explode(F.expr("sequence(0L, nb - 1L)")).alias("b")))
    held = (index.join(plan, "group").select("cid", "m", "v", "code", "err", "list", "group", F.explode(F.expr("sequence(0L, nq - 1L)")).alias("qb"),
                                             F.expr("pmod(xxhash64(cid), nb)").alias("b")))
    key = ["group", "qb", "b"]
    held = held.select("cid", "m", "v", "code", "err", "list", *key).toDF("cid", "m", "v", "code", "err", "list", *(f"i_{k}" for k in key))
    links = settle(asked.groupBy(*key).cogroup(held.groupBy(*(f"i_{k}" for k in key))).applyInArrow(_search(z, least, kind, cosine), "cid long, n long, root long"), "pq-links")
    release(index)
    return links


def near_duplicates(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """Links, component and keeper of every row of ``vectors`` (``vec_id``, ``embedding``).

    Returns ``vec_id``, ``n_links``, ``component_id``, ``kept``.  Vectors that
    are null, empty, zero, or hold null or non-finite parts link with nothing,
    nor do rows with a null id (null component, not kept).  Vectors link with
    those of their own length; each length is indexed and searched on its own.
    Rows that repeat an
    id and its vector count as vectors of their own; different vectors of one
    id share their links.  Other columns are ignored; an empty table gives an
    empty result.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.withColumn("ok", F.expr(usable()))
    classes = cut(rows.where("ok").groupBy("v").agg(F.min("vec_id").alias("cid"), F.count("*").alias("m")))
    dims = [r["d"] for r in classes.select(F.size("v").alias("d")).distinct().orderBy("d").collect()]
    if not dims:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType == T.FloatType() else "<f8"
    found = reduce(DataFrame.union, [_found(classes.where(F.size("v") == d), d, cosine, kind) for d in dims])
    links = found.groupBy("cid").agg(F.sum("n").alias("n"))
    comp = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    known = (classes.join(links, "cid", "left").join(comp.toDF("cid", "component"), "cid", "left")
             .select("v", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "cid").alias("component_id")))
    out = rows.where("ok").join(known, "v").select("vec_id", "n_links", "component_id")
    out = out.unionByName(rows.where("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op7_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_OP7 = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
p AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
r(vec_id, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT p.b, r.c FROM r JOIN p ON p.a = r.vec_id),
m AS (SELECT vec_id, min(c) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN m USING (vec_id) LEFT JOIN n USING (vec_id)
"""
