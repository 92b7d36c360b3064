"""Embedding whitening by incremental eigendecomposition.

Each partition of the distinct vectors keeps the eigendecomposition of its own scatter matrix and takes
every vector in as a centred rank-one update: the new eigenvalues are the roots of a secular equation, found
for all at once, after deflation (entries of no weight, and all but one direction of equal eigenvalues, keep
their vectors). Partial spectra are combined in a tree, where one spectrum takes in the other's vectors, and
the shift between the two means, as further rank-one updates. Rounding is then taken out by one
distributed Rayleigh-Ritz step: the covariance seen in the combined basis, summed over all vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursematch.llm.common import Store

EPS = np.finfo(float).eps
#: Spectra combined by one task of the tree.
FAN_IN = 16


# ---------------------------------------------------------------- rank-one update

def secular_roots(d: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The eigenvalues of diag(d) + z z', d strictly ascending and no z zero, as differences: row i, column j is
    root j less d[i]. Differences are what the vectors need; each root is found as an offset from its nearer pole."""
    n = len(d)
    w = z * z
    upper = np.append(d[1:], d[-1] + w.sum())
    gap = upper - d
    mid = d + gap / 2
    at_mid = 1 + (w[:, None] / (d[:, None] - mid)).sum(0)
    left = (at_mid >= 0) | (np.arange(n) == n - 1)
    origin = np.where(left, d, upper)
    delta = d[:, None] - origin  # poles seen from each root's origin
    lo = np.where(left, 0.0, -gap / 2)
    hi = np.where(left, np.where(at_mid >= 0, gap / 2, gap), 0.0)
    lo[-1] = 0.0 if at_mid[-1] >= 0 else gap[-1] / 2
    lo_pole, hi_pole = d - origin, upper - origin
    below = np.arange(n)[:, None] <= np.arange(n)
    mu = (lo + hi) / 2
    for _ in range(80):
        t = w[:, None] / (delta - mu)
        s = t / (delta - mu)
        f = 1 + t.sum(0)
        hi = np.where(f >= 0, np.minimum(hi, mu), hi)
        lo = np.where(f < 0, np.maximum(lo, mu), lo)
        found = np.abs(f) <= 16 * EPS * (1 + np.abs(t).sum(0))
        if found.all():
            break
        # a rational model with the two neighbouring poles; outside the bracket: halve it
        psi, phi = (s * below).sum(0), (s * ~below).sum(0)
        a, b = lo_pole - mu, hi_pole - mu
        c = f - a * psi - b * phi
        p = (a + b) * f - a * b * (psi + phi)
        q = a * b * f
        root = np.sqrt(np.maximum(p * p - 4 * q * c, 0))
        with np.errstate(all="ignore"):
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            new = mu + step
        new = np.where(np.isfinite(new) & (new > lo) & (new < hi), new, (lo + hi) / 2)
        new = np.where(found, mu, new)
        if (new == mu).all():
            break
        mu = new
    mu = np.where(mu == 0, np.where(left, np.finfo(float).tiny, -np.finfo(float).tiny), mu)
    return mu - delta


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The eigendecomposition of ``vectors diag(values) vectors' + rho v v'`` for rho >= 0; values ascending."""
    z = vectors.T @ v * np.sqrt(rho)
    norm = np.sqrt(z @ z)
    if not norm:
        return values, vectors
    tol = 8 * EPS * max(np.abs(values).max(), norm * norm)
    # deflation: of equal values, one reflection turns all weight into one direction
    edge = np.flatnonzero(np.append(True, np.diff(values) > tol))
    sizes = np.diff(np.append(edge, len(values)))
    if (sizes > 1).any():
        vectors = vectors.copy()
        for at, k in zip(edge[sizes > 1], sizes[sizes > 1]):
            part = z[at: at + k].copy()
            length = np.sqrt(part @ part)
            if not length:
                continue
            h = part.copy()
            h[-1] += np.copysign(length, part[-1])
            block = vectors[:, at: at + k]
            vectors[:, at: at + k] = block - np.outer(block @ h, h) * (2 / (h @ h))
            z[at: at + k] = 0
            z[at + k - 1] = -np.copysign(length, part[-1])
    live = np.abs(z) * norm > tol
    if not live.any():
        return values, vectors
    d, w = values[live], z[live]
    if len(d) == 1:
        new, turned = d + w * w, vectors[:, live]
    else:
        diff = secular_roots(d, w)  # [i, j]: root j - d[i]
        poles = d - d[:, None]  # [i, j]: d[j] - d[i]
        np.fill_diagonal(poles, 1.0)
        # weights for which these roots are exact, so that the vectors come out orthogonal
        weight = np.sqrt(np.abs((diff / poles).prod(1)))
        u = np.copysign(weight, w)[:, None] / diff
        u /= np.sqrt((u * u).sum(0))
        near = np.abs(diff).argmin(0)
        new = d[near] + diff[near, np.arange(len(d))]
        turned = vectors[:, live] @ u
    values, vectors = values.copy(), vectors.copy()
    values[live], vectors[:, live] = new, turned
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Number, mean and eigendecomposed scatter of the vectors taken in so far."""

    def __init__(self, n: int, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray):
        self.n, self.mean, self.values, self.vectors = n, mean, values, vectors

    @classmethod
    def empty(cls, dims: int) -> Spectrum:
        return cls(0, np.zeros(dims), np.zeros(dims), np.eye(dims))

    def add(self, x: np.ndarray) -> None:
        """One vector: a rank-one update of the scatter around the moving mean."""
        step = x - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, step, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + step / self.n

    def merge(self, other: Spectrum) -> None:
        """Another spectrum: one update for each of its vectors, and one for the shift of the means."""
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, value)
        step = other.mean - self.mean
        n = self.n + other.n
        self.values, self.vectors = rank_one(self.values, self.vectors, step, self.n / n * other.n)
        self.mean = self.mean + step * (other.n / n)
        self.n = n

    def pack(self) -> bytes:
        return np.concatenate([[float(self.n)], self.mean, self.values, self.vectors.ravel()]).tobytes()

    @classmethod
    def unpack(cls, dims: int, data: bytes) -> Spectrum:
        a = np.frombuffer(data)
        return cls(int(a[0]), a[1: 1 + dims], a[1 + dims: 1 + 2 * dims], a[1 + 2 * dims:].reshape(dims, dims))


# ---------------------------------------------------------------- tasks

PARTIAL = "id long, dims int, state binary"


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch, np.ndarray]]:
    """Vectors of each length: the length, them as rows, their batch, and their places in it."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index("x"))
        sizes = np.asarray(col.value_lengths())
        for dims in np.unique(sizes):
            rows = np.flatnonzero(sizes == dims)
            part = col if len(rows) == len(sizes) else col.take(pa.array(rows))
            yield int(dims), np.asarray(part.flatten()).reshape(len(rows), int(dims)), batch, rows


def _partial(make: Callable, add: Callable, pack: Callable) -> Callable:
    """A task that folds its vectors into one state for each length."""
    def task(batches):
        states: dict = {}
        for dims, x, _, _ in _vectors(batches):
            states[dims] = add(states.get(dims) if dims in states else make(dims), x)
        at = TaskContext.get().partitionId()
        if states:
            yield pa.RecordBatch.from_pydict({"id": [at] * len(states), "dims": list(states), "state": [pack(s) for s in states.values()]},
                                             pa.schema([("id", pa.int64()), ("dims", pa.int32()), ("state", pa.binary())]))
    return task


def _tree(parts: DataFrame, store: Store, merge: Callable[[int, bytes | None, bytes], bytes]) -> dict[int, bytes]:
    """One state for each length, merged by levels of ``FAN_IN``; only the last ones come to the driver."""
    def task(batches):
        held: dict = {}
        for batch in batches:
            for i, dims, state in zip(*(c.to_pylist() for c in batch.columns)):
                held[i, dims] = merge(dims, held.get((i, dims)), state)
        if held:
            yield pa.RecordBatch.from_pydict({"id": [k[0] for k in held], "dims": [k[1] for k in held], "state": list(held.values())},
                                             pa.schema([("id", pa.int64()), ("dims", pa.int32()), ("state", pa.binary())]))

    last = parts.agg(F.max("id")).first()[0]
    while last is not None and last > 0:
        last //= FAN_IN
        level = parts.select((F.floor(F.col("id") / FAN_IN)).alias("id"), "dims", "state").repartition(int(last) + 1, "id", "dims")
        merged = store.put(level.sortWithinPartitions("id", "dims").mapInArrow(task, PARTIAL), "merged")
        store.drop(parts)
        parts = merged
    return {r.dims: r.state for r in parts.collect()}


def _take_in(state: Spectrum, x: np.ndarray) -> Spectrum:
    for row in x.astype(float):
        state.add(row)
    return state


def _merge_spectra(dims: int, held: bytes | None, other: bytes) -> bytes:
    if held is None:
        return other
    s = Spectrum.unpack(dims, held)
    s.merge(Spectrum.unpack(dims, other))
    return s.pack()


def _add_sums(_: int, held: bytes | None, other: bytes) -> bytes:
    return other if held is None else (np.frombuffer(held) + np.frombuffer(other)).tobytes()


def _second_moments(store: Store, fit: DataFrame, means: dict, maps: dict) -> dict[int, np.ndarray]:
    """For each length, the mean of y and of y y' over the vectors, y = (x - mean) map, as one matrix with the mean as its last row."""
    def add(state, x):
        dims = x.shape[1]
        y = (x - means[dims]) @ maps[dims]
        part = np.vstack([y.T @ y, y.sum(0)])
        return part if state is None else state + part

    parts = store.put(fit.mapInArrow(_partial(lambda dims: None, add, lambda s: s.tobytes()), PARTIAL), "moments")
    return {d: np.frombuffer(b).reshape(maps[d].shape[1] + 1, -1) for d, b in _tree(parts, store, _add_sums).items()}


# ---------------------------------------------------------------- operator

def quantised(vector: Column) -> Column:
    """Null where the vector is null or holds null or non-finite entries; else floor(256 c) of each entry as a long (cut at 64 bits)."""
    value = lambda c: c.cast("double")
    sound = F.forall(vector, lambda c: F.coalesce(c.isNotNull() & ~F.isnan(value(c)) & (F.abs(value(c)) < float("inf")), F.lit(False)))
    return F.when(sound, F.transform(vector, lambda c: F.floor(value(c) * 256).cast("long")))


def whiten(vectors: DataFrame, components: int = 4, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``id_column``, component, n, deviation, whitened, explained, identity_error for each row that has a sound vector.

    x is the quantised vector. The fit list holds each distinct x once: n of them with sums S; covariances
    have the divisor n. ``deviation`` is the exact sum of (n x - S)^2 as decimal(38, 0). ``whitened`` is x less the mean on the component,
    over the root of its eigenvalue; ``explained`` the eigenvalue's share of the trace; ``identity_error`` the
    largest absolute entry of the whitened fit list's covariance less the identity, measured over the fit list.

    Rows whose vector is null or holds null or non-finite entries are left out; repeated rows repeat, null
    ids stay. Vectors of unlike lengths are fitted apart, each length by itself; an empty vector has no
    component and gives no row. A component without variance (a single or constant vector) has a null ``whitened`` and
    counts in no ``identity_error``; without any, that is 0. An empty table gives an empty one.
    """
    spark = vectors.sparkSession
    store = Store(spark, "whitening")
    kept = vectors.select(F.col(id_column).alias("_id"), quantised(F.col(vector_column)).alias("x")).where("x is not null and size(x) > 0")
    fit = store.put(kept.select("x").distinct(), "fit")
    # exact sums, as they grow past 64 bits in no real table but may in odd ones
    sums = {r.dims: (r.n, r.sums) for r in (
        fit.select(F.size("x").alias("dims"), F.posexplode("x").alias("at", "v")).groupBy("dims", "at").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
        .groupBy("dims").agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("at", "s"))), lambda e: e.s).alias("sums"))).collect()}
    n = {d: int(c) for d, (c, _) in sums.items()}
    s = {d: [int(v) for v in total] for d, (_, total) in sums.items()}
    mean = {d: np.array([v / n[d] for v in s[d]]) for d in s}
    parts = store.put(fit.mapInArrow(_partial(Spectrum.empty, _take_in, Spectrum.pack), PARTIAL), "spectra")
    basis = {d: np.linalg.qr(Spectrum.unpack(d, b).vectors)[0] for d, b in _tree(parts, store, _merge_spectra).items()}
    # Rayleigh-Ritz: the covariance in the combined basis, centred once more (the means above are rounded)
    seen = _second_moments(store, fit, mean, basis)
    model = {}
    for d, m in seen.items():
        drift = m[-1] / n[d]
        values, turn = np.linalg.eigh(m[:-1] / n[d] - np.outer(drift, drift))
        trace = values.sum()
        values, axes = values[::-1][:components], (basis[d] @ turn)[:, ::-1][:, :components]
        live = values > max(trace, 0) * 1e-13
        with np.errstate(all="ignore"):
            model[d] = axes, np.where(live, 1 / np.sqrt(np.where(live, values, 1)), np.nan), np.where(trace > 0, values / trace, 0.0)
    checked = _second_moments(store, fit, mean, {d: a * np.nan_to_num(scale) for d, (a, scale, _) in model.items()})
    error = {}
    for d, m in checked.items():
        live = np.isfinite(model[d][1])
        drift = m[-1] / n[d]
        off = np.abs(m[:-1] / n[d] - np.outer(drift, drift) - np.eye(len(live)))[np.ix_(live, live)]
        error[d] = float(off.max()) if off.size else 0.0

    def task(batches):
        for d, x, batch, rows in _vectors(batches):
            axes, scale, share = model[d]
            k = len(scale)
            ids = batch.column(0).take(pa.array(np.repeat(rows, k)))
            most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n[d] + max(map(abs, s[d]))
            whole = most * most * d < 1 << 62
            off = x * n[d] - np.array(s[d]) if whole else x.astype(object) * n[d] - np.array(s[d], dtype=object)
            deviation = (off * off).sum(1)
            away = off.astype(float) / n[d]
            white = away @ axes * scale
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))), pa.array(np.full(len(rows) * k, n[d])),
                pa.array([str(v) for v in np.repeat(deviation, k)], pa.string()), pa.array(white.ravel(), mask=np.isnan(white.ravel())),
                pa.array(np.tile(share, len(rows))), pa.array(np.full(len(rows) * k, error[d]))],
                names=["_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    id_type = vectors.schema[id_column].dataType.simpleString()
    out = kept.mapInArrow(task, f"_id {id_type}, component int, n long, deviation string, whitened double, explained double, identity_error double")
    return out.select(F.col("_id").alias(id_column), "component", "n", F.col("deviation").cast("decimal(38,0)").alias("deviation"), "whitened", "explained", "identity_error")
