"""Embedding whitening from a bit-sliced scatter.

1. Entries become integers (``floor(1024 c) + 100000``), so every sum is exact.
2. Each task takes blocks of rows, shifts every dimension by the block's
   smallest value and packs the bit planes of each dimension across the rows
   into 64-bit words.  The scatter of two dimensions is the sum over pairs of
   their planes of ``2**(a+b) * popcount(plane_a & plane_b)``; the shift is
   put back afterwards.  A task returns one row per pair of dimensions.
3. Spark adds these rows up.  The driver receives dimensions x dimensions
   sums, whatever the number of vectors, centres them as integers
   (``n * sum(xy) - sum(x) * sum(y)``), divides once and calls ``eigh``.
4. A second pass projects the rows, centred before multiplying.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.components import settle

#: Integer form of an entry: ``floor(SCALE * c) + SHIFT``.
SCALE, SHIFT = 1024.0, 100_000
#: Largest size of ``SCALE * c``; entries beyond it count as of this size.
MOST = 9.2e18
COMPONENTS = 8
#: Rows of a block at most, and entries of a block (a block of long vectors has fewer rows).
BLOCK_ROWS, BLOCK_ENTRIES = 1 << 16, 1 << 22
#: Bits of a limb: exact sums travel as four of them, the last one signed.
LIMB, LIMBS = 40, 4
#: Words of the bit planes that are multiplied at a time (they stay in the processor's cache).
_WORDS = 128


def integers(v: np.ndarray) -> np.ndarray:
    """The integer form of finite entries."""
    return np.clip(np.floor(SCALE * v), -MOST, MOST).astype(np.int64) + SHIFT


def bit_planes(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of unsigned columns: words (plane, word), the dimension and the bit of each plane.

    A dimension has as many planes as its largest value has bits, one at
    least; rows are padded with zeros to whole words.
    """
    rows, dims = u.shape
    bits = [max(int(x).bit_length(), 1) for x in u.max(0)]
    pad = -rows % 64
    t = np.zeros((dims, rows + pad), np.uint64)
    t[:, :rows] = u.T
    of, bit = np.repeat(np.arange(dims), bits), np.concatenate([np.arange(b) for b in bits])
    planes = np.empty((len(of), (rows + pad) // 64), np.uint64)
    for b in range(max(bits)):
        at = np.flatnonzero(bit == b)
        planes[at] = np.packbits(((t[of[at]] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=1).view(np.uint64)
    return planes, of, bit


def _common_bits(planes: np.ndarray) -> np.ndarray:
    """Rows that each pair of planes has in common (the upper triangle)."""
    n = len(planes)
    out = np.zeros((n, n), np.int64)
    for lo in range(0, planes.shape[1], _WORDS):
        part = np.ascontiguousarray(planes[:, lo: lo + _WORDS])
        for p in range(n):
            out[p, p:] += np.bitwise_count(part[p] & part[p:]).sum(1, dtype=np.int64)
    return out


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact column sums and sums of products (object arrays of Python integers) of integer rows."""
    rows, dims = x.shape
    low = x.min(0)
    u = x.view(np.uint64) - low.view(np.uint64)  # modulo 2**64, so the full range of a long is fine
    planes, of, bit = bit_planes(u)
    both = _common_bits(planes)
    both += np.triu(both, 1).T
    own = np.diagonal(both)
    wide = 2 * int(bit.max()) + 2 + rows.bit_length() > 62
    power = np.array([1 << int(b) for b in bit], dtype=object if wide else np.int64)
    first = np.searchsorted(of, np.arange(dims))
    total = np.add.reduceat(own * power, first).astype(object)
    products = np.add.reduceat(np.add.reduceat(both * power[:, None] * power[None, :], first, axis=0), first, axis=1).astype(object)
    m = low.astype(object)
    products = products + np.outer(m, total) + np.outer(total, m) + rows * np.outer(m, m)
    return total + rows * m, products


def _rows(batches):
    """Row blocks by vector length: (length, matrix of doubles, ids)."""
    for b in batches:
        if not len(b):
            continue
        v = b.column("v")
        size = np.asarray(v.value_lengths())
        for dim in np.unique(size):
            at = pa.array(np.flatnonzero(size == dim))
            some = v.take(at)
            yield int(dim), np.asarray(some.flatten(), np.float64).reshape(-1, dim), b.column("vec_id").take(at)


def _sum_task(batches):
    held: dict[int, list] = {}
    sums: dict[int, list] = {}

    def fold(dim):
        x = np.concatenate(held.pop(dim))
        s, p = scatter(x)
        t = sums.setdefault(dim, [0, 0, 0])
        t[0], t[1], t[2] = t[0] + len(x), t[1] + s, t[2] + p

    for dim, v, _ in _rows(batches):
        rows = max(64, min(BLOCK_ROWS, BLOCK_ENTRIES // dim // 64 * 64))
        for lo in range(0, len(v), rows):
            held.setdefault(dim, []).append(integers(v[lo: lo + rows]))
            if sum(map(len, held[dim])) >= rows:
                fold(dim)
    for dim in list(held):
        fold(dim)
    for dim, (n, s, p) in sums.items():
        i, j = np.triu_indices(dim)
        what = [(-1, -1, n), *((-1, k, int(x)) for k, x in enumerate(s)), *zip(i.tolist(), j.tolist(), p[i, j].tolist())]
        yield pa.RecordBatch.from_pylist(
            [{"dim": dim, "i": a, "j": b, **{f"l{k}": v >> LIMB * k if k == LIMBS - 1 else v >> LIMB * k & (1 << LIMB) - 1 for k in range(LIMBS)}}
             for a, b, v in what], schema=_SUMS)


_SUMS = pa.schema([("dim", pa.int32()), ("i", pa.int32()), ("j", pa.int32())] + [(f"l{k}", pa.int64()) for k in range(LIMBS)])
_SUMS_SQL = "dim int, i int, j int, " + ", ".join(f"l{k} long" for k in range(LIMBS))


class Whitener:
    """Fitted from exact sums: the count, sums and sums of products of integer vectors of one length."""

    def __init__(self, n: int, sums: np.ndarray, products: np.ndarray, components: int = COMPONENTS):
        self.n, self.sums = n, sums
        scatter = n * products - np.outer(sums, sums)  # n**2 times the covariance, exact
        self.covariance = np.array([[c / (n * n) for c in row] for row in scatter], np.float64)
        trace = sum(int(scatter[i, i]) for i in range(len(sums)))
        values, vectors = np.linalg.eigh(self.covariance)
        order = np.argsort(-values, kind="stable")[:components]
        self.values, self.vectors = values[order], vectors[:, order]
        self.explained = [float(e) / (trace / (n * n)) if trace else None for e in self.values]
        #: Components with variance; that of the others is rounding, so rows have no whitened value there.
        self.ranked = self.values > len(sums) * np.finfo(float).eps * max(float(values[-1]), 0.0)

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exact: 64-bit where it fits, else Python integers."""
        big = max(abs(int(x.max())), abs(int(x.min()))) * self.n + max(abs(int(s)) for s in self.sums)
        return self.n * (x if big < 1 << 62 else x.astype(object)) - (self.sums.astype(np.int64) if big < 1 << 62 else self.sums)

    def deviations(self, d: np.ndarray) -> list[int]:
        """Sum of squares of each row of offsets, exact."""
        if d.dtype != object and int(np.abs(d).max()) ** 2 * d.shape[1] < 1 << 63:
            return (d * d).sum(1).tolist()
        return [sum(int(y) * int(y) for y in row) for row in d]

    def project(self, d: np.ndarray) -> np.ndarray:
        """Whitened values of offsets; NaN on components without variance."""
        z = (d / self.n).astype(np.float64) @ self.vectors
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.ranked, z / np.sqrt(np.maximum(self.values, 0)), np.nan)


def _usable(vectors: DataFrame) -> DataFrame:
    ok = "v IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where(ok)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Whitener]:
    """A whitener for each vector length, fitted on all usable rows of ``vectors`` (``vec_id``, ``embedding``)."""
    parts = _usable(vectors).mapInArrow(_sum_task, _SUMS_SQL)
    rows = parts.groupBy("dim", "i", "j").agg(*(F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS))).collect()
    value = {(r["dim"], r["i"], r["j"]): sum(r[f"l{k}"] << LIMB * k for k in range(LIMBS)) for r in rows}
    out = {}
    for dim in sorted({k[0] for k in value}):
        sums = np.array([value[dim, -1, k] for k in range(dim)], dtype=object)
        products = np.array([[value[dim, min(i, j), max(i, j)] for j in range(dim)] for i in range(dim)], dtype=object)
        out[dim] = Whitener(value[dim, -1, -1], sums, products, components)
    return out


def _project_task(shared):
    def run(batches):
        for dim, v, ids in _rows(batches):
            w = shared.value[dim]
            d = w.offsets(integers(v))
            z, k = w.project(d), len(w.values)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([dim] * len(v), pa.int32()), pa.array([str(x) for x in w.deviations(d)]),
                 pa.ListArray.from_arrays(np.arange(0, len(v) * k + 1, k, dtype=np.int32), pa.array(z.ravel()))],
                ["vec_id", "dim", "deviation", "z"])
    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, dict[int, Whitener], dict[int, float | None]]:
    """Rows (``vec_id``, ``dim``, ``deviation`` as decimal text, ``z``), the whiteners and the identity errors by length.

    Rows whose vector is null, empty or holds null or non-finite entries are
    dropped.  Vectors of different lengths are fitted apart.  Rows with a null
    or repeated ``vec_id`` count as rows of their own; other columns are
    ignored; an empty table gives no rows.  A vector has at most as many
    components as entries.  Equal eigenvalues keep the order that ``eigh``
    gives.  Components without variance (fewer rows than dimensions, constant
    entries) have a NaN in ``z`` and are left out of the identity error, which
    is None if no component is left.  Entries with ``|1024 c|`` beyond 9.2e18
    count as of that size.
    """
    models = fit(vectors, components)
    shared = vectors.sparkSession.sparkContext.broadcast(models)
    rows = settle(_usable(vectors).mapInArrow(_project_task(shared), "vec_id long, dim int, deviation string, z array<double>"), "whitened")
    errors: dict[int, float | None] = {}
    z = [F.get("z", F.lit(k)) for k in range(components)]
    means = {r["dim"]: r for r in rows.groupBy("dim").agg(*(F.avg(c).alias(f"m{k}") for k, c in enumerate(z))).collect()}
    if means:
        mean = F.create_map(*(x for dim, r in means.items() for x in (F.lit(dim), F.array(*(F.lit(r[f"m{k}"]).cast("double") for k in range(components))))))
        centred = rows.select("dim", F.zip_with("z", F.element_at(mean, F.col("dim")), lambda a, b: a - b).alias("c"))
        pairs = [(i, j) for i in range(components) for j in range(i, components)]
        sums = centred.groupBy("dim").agg(*(F.avg(F.get("c", F.lit(i)) * F.get("c", F.lit(j))).alias(f"p{i}_{j}") for i, j in pairs)).collect()
        for r in sums:
            kept = np.flatnonzero(models[r["dim"]].ranked)
            errors[r["dim"]] = max((float(abs(r[f"p{i}_{j}"] - (i == j))) for i in kept for j in kept if i <= j), default=None)
    return rows, models, errors


def op11_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    """One row for each usable vector and component; ``deviation`` is null where it does not fit a long."""
    rows, models, errors = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    facts = spark.createDataFrame(
        [(dim, k, w.n, w.explained[k], errors.get(dim)) for dim, w in models.items() for k in range(len(w.values))],
        "dim int, k int, n long, explained double, identity_error double")
    out = rows.select("vec_id", "dim", F.expr("try_cast(deviation AS long)").alias("deviation"), F.posexplode("z").alias("k", "z"))
    return out.join(F.broadcast(facts), ["dim", "k"]).select(
        "vec_id", (F.col("k") + 1).alias("component"), "n", "deviation", F.when(~F.isnan("z"), F.col("z")).alias("whitened"), "explained", "identity_error")
