"""Whitening of embeddings: leading principal components by spectrum slicing, every row projected and scaled to unit variance.

Entries ``c`` become integers ``floor(256 * c)``.  The fit list holds each distinct integer vector once.

* **Covariance.**  Vectors are packed into the narrowest integers that hold them, made distinct and written.  One pass over
  that list sums each dimension exactly, a second sums products of centred entries per task; a task sends one row a
  dimension, and these rows are added in two steps, so no sum gathers more than a bounded share of the tasks' rows at once.
* **Spectrum slicing.**  In one task for each length of vectors, the pivots of LDL^T of the covariance less a shift count the
  eigenvalues above the shift.  Bisection on these counts isolates each leading eigenvalue in an interval of its own, Rayleigh
  quotient iteration converges to it cubically, and two more counts just beside the result certify its number.  A result
  outside the interval is not taken: the interval is halved further and the iteration starts again.
* **Projection.**  A last pass over all rows, with the components (a few vectors) sent along.

Vectors that are null or hold null or non-finite entries take no part.  Each length of vectors is a space of its own; empty
vectors have no dimension and give no rows.  Components whose variance is rounding (2e-11 of the largest or less) cannot be
scaled and are left out, so a space of one distinct vector gives no rows.  Equal eigenvalues have orthogonal components that span the same space.  Integers beyond 64
bits are held at the nearest one; a deviation beyond them is null.  Repeated rows give rows of their own and count once in
the fit; null and repeated ids are carried.  Further columns take no part.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaweave.llm.common import written

SCALE = 256
COMPONENTS = 4
#: Tasks' rows of products that are added at once.
FAN_IN = 64
#: Packed vectors handled at once.
BATCH_BYTES = 1 << 22
#: A component counts if rounding moves its variance by less than this share; else it is rounding itself.
MAX_ROUNDING = 1e-5
_LONG = 1 << 63


# -- vectors -----------------------------------------------------------------------

def integers(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of the vectors of an Arrow list column: rows and integers (rows x length) of those that take part."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.where(np.asarray(column.is_valid()), np.asarray(column.value_lengths().fill_null(0)), 0).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null entry reads as NaN
    ends = np.cumsum(sizes)
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        entries = flat[(ends[rows] - size)[:, None] + np.arange(size)]
        fine = np.isfinite(entries).all(axis=1)
        with np.errstate(over="ignore"):
            x = np.floor(entries[fine] * SCALE)
        low, high = x < -float(_LONG), x >= float(_LONG)
        x = np.where(low | high, 0, x).astype(np.int64)
        x[low], x[high] = -_LONG, _LONG - 1
        yield rows[fine], x


def pack(x: np.ndarray) -> list[bytes]:
    """Each row in the narrowest of 16, 32 or 64-bit integers that hold it, the width first: equal rows pack equally."""
    out = np.empty(len(x), object)
    most, least = x.max(axis=1), x.min(axis=1)
    done = np.zeros(len(x), bool)
    for width in (2, 4, 8):
        bound = 1 << (8 * width - 1)
        rows = np.flatnonzero(~done & (most < bound) & (least >= -bound)) if width < 8 else np.flatnonzero(~done)
        done[rows] = True
        for i, data in zip(rows, x[rows].astype(f"<i{width}"), strict=True):
            out[i] = bytes([width]) + data.tobytes()
    return out.tolist()


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Matrices of packed vectors of one length and width, of bounded size."""
    for batch in batches:
        groups: dict[tuple[int, int], list[bytes]] = {}
        for v in batch.column("x").to_pylist():
            groups.setdefault((v[0], len(v)), []).append(v[1:])
        for (width, size), rows in groups.items():
            step = max(1, BATCH_BYTES // (8 * (size // width)))
            for i in range(0, len(rows), step):
                yield np.frombuffer(b"".join(rows[i:i + step]), f"<i{width}").reshape(-1, (size - 1) // width).astype(np.int64)


def fit_list(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """``(x)``: each distinct packed integer vector once."""
    def packed(batches):
        for batch in batches:
            for _, x in integers(batch.column(0)):
                yield pa.record_batch({"x": pa.array(pack(x), pa.binary())})

    return embeddings.select(vector).mapInArrow(packed, "x binary").distinct()


# -- sums, distributed -----------------------------------------------------------------

def _whole(values: np.ndarray, bound: int) -> np.ndarray:
    """``values`` as 64-bit integers where sums up to ``bound`` fit, else as Python's."""
    return values if bound < _LONG else values.astype(object)


def sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """For each length the number of vectors and the exact sum of each dimension."""
    def partial(batches):
        total: dict[int, list] = {}
        for x in unpacked(batches):
            bound = max(int(x.max()), -int(x.min())) * len(x)
            own = total.setdefault(x.shape[1], [0, 0])
            own[0] += len(x)
            own[1] = own[1] + _whole(x, bound).sum(axis=0).astype(object)
        for d, (n, s) in total.items():
            yield pa.record_batch({"d": pa.array([d] * d, pa.int32()), "i": pa.array(range(d), pa.int32()), "n": pa.array([n] * d, pa.int64()),
                                   "s": pa.array([str(int(v)) for v in s])})

    rows = fit.mapInArrow(partial, "d int, i int, n long, s string").groupBy("d", "i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("d", "i").collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        out.setdefault(r.d, (r.n, []))[1].append(int(r.s))
    return out


def centred(x: np.ndarray, n: int, s: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """``n * x - s``, exactly, and the same over ``n`` as doubles."""
    bound = n * max(int(x.max()), -int(x.min()), 1) + max(map(abs, s))
    exact = (x if bound < _LONG else x.astype(object)) * n - np.array(s, np.int64 if bound < _LONG else object)
    return exact, (exact / n).astype(np.float64)


def products(fit: DataFrame, totals: dict[int, tuple[int, list[int]]]) -> DataFrame:
    """``(d, i, row)``: rows of the covariance of each length, as doubles."""
    def partial(batches):
        total: dict[int, np.ndarray] = {}
        for x in unpacked(batches):
            n, s = totals[x.shape[1]]
            _, c = centred(x, n, s)
            total[x.shape[1]] = total.get(x.shape[1], 0) + c.T @ c
        for d, g in total.items():
            yield pa.record_batch({"d": pa.array([d] * d, pa.int32()), "i": pa.array(range(d), pa.int32()), "row": pa.array([r.tobytes() for r in g / totals[d][0]])})

    def add(block: pd.DataFrame) -> pd.DataFrame:
        row = np.frombuffer(b"".join(block["row"])).reshape(len(block), -1).sum(axis=0)
        return pd.DataFrame({"d": block["d"].iloc[:1], "i": block["i"].iloc[:1], "row": [row.tobytes()]})

    schema = "d int, i int, row binary"
    parts = fit.mapInArrow(partial, schema).withColumn("part", F.spark_partition_id())
    some = parts.groupBy("d", "i", F.floor(F.col("part") / FAN_IN).alias("part")).applyInPandas(add, schema)
    return some.groupBy("d", "i").applyInPandas(add, schema)


# -- spectrum slicing ------------------------------------------------------------------

def count_above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of the symmetric ``v`` above ``shift``: positive pivots of LDL^T of ``v - shift`` (Sylvester's inertia).

    Diagonal pivoting with blocks of one or two keeps the factors bounded.
    """
    a = v - shift * np.eye(len(v))
    above = 0
    least = (1 + np.sqrt(17)) / 8
    while len(a):
        column = np.abs(a[1:, 0])
        r = int(column.argmax()) + 1 if len(column) else 0
        big = column[r - 1] if r else 0.0
        if abs(a[0, 0]) < least * big:
            other = np.abs(a[r]).copy()
            other[r] = 0
            reach = other.max()
            if abs(a[0, 0]) * reach >= least * big * big:
                pass
            elif abs(a[r, r]) >= least * reach:
                a[[0, r]] = a[[r, 0]]
                a[:, [0, r]] = a[:, [r, 0]]
            else:  # a block of two, of negative determinant: one pivot of either sign
                a[[1, r]] = a[[r, 1]]
                a[:, [1, r]] = a[:, [r, 1]]
                above += 1
                low = a[2:, :2]
                a = a[2:, 2:] - low @ np.linalg.solve(a[:2, :2], low.T)
                continue
        pivot = a[0, 0]
        above += pivot > 0
        low = a[1:, 0]
        a = a[1:, 1:] - np.outer(low, low / pivot) if pivot else a[1:, 1:]
    return above


def _against(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """``x`` of unit length, orthogonal to ``others``."""
    for _ in range(2):
        for o in others:
            x = x - (o @ x) * o
    return x / np.linalg.norm(x)


def _solve(v: np.ndarray, shift: float, x: np.ndarray, tiny: float) -> np.ndarray:
    """``(v - shift)^-1 x`` up to scale; a shift that is an eigenvalue to the last bit is moved by ``tiny``."""
    for away in (0.0, tiny, -2 * tiny, 4 * tiny):
        try:
            y = np.linalg.solve(v - (shift + away) * np.eye(len(v)), x)
        except np.linalg.LinAlgError:
            continue
        size = np.abs(y).max()
        if np.isfinite(size) and size > 0:
            return y / size
    return x


def _rayleigh(v: np.ndarray, shift: float, start: np.ndarray, others: list[np.ndarray], tiny: float) -> tuple[float, np.ndarray, float]:
    """Eigenvalue, unit eigenvector and residual: two steps of inverse iteration at ``shift``, then Rayleigh quotients."""
    x = _against(start, others)
    for _ in range(2):
        x = _against(_solve(v, shift, x, tiny), others)
    rho, best = float(x @ v @ x), None
    for _ in range(12):
        residual = float(np.linalg.norm(v @ x - rho * x))
        if best is not None and residual >= best[2]:
            break
        best = (rho, x, residual)
        x = _against(_solve(v, rho, x, tiny), others)
        rho = float(x @ v @ x)
    return best


def leading_eigenpairs(v: np.ndarray, k: int) -> list[tuple[float, np.ndarray]]:
    """The up to ``k`` largest eigenvalues above rounding of the covariance ``v`` with unit eigenvectors, falling."""
    d = len(v)
    scale = float(np.abs(v).max())
    if not scale > 0:
        return []
    v = (v + v.T) / (2 * scale)
    reach = float(np.abs(v).sum(axis=1).max())
    tiny = np.finfo(float).eps * reach
    known = {-reach * 1.01: d, reach * 1.01: 0}  # eigenvalues above each shift counted so far

    def count(shift: float) -> int:
        if shift not in known:
            known[shift] = count_above(v, shift)
        return known[shift]

    starts = np.random.default_rng(13).standard_normal((d, d))
    pairs: list[tuple[float, np.ndarray]] = []
    for j in range(1, min(k, d) + 1):
        low = max(s for s, n in known.items() if n >= j)
        high = min(s for s, n in known.items() if n < j)
        others, found = [x for _, x in pairs], None
        while found is None:
            mid = (low + high) / 2
            together = high - low <= 4 * tiny or not low < mid < high
            if together or (count(low) == j and count(high) == j - 1):
                e, x, residual = _rayleigh(v, mid, starts[j - 1], others, tiny)
                beside = max(4 * residual, 8 * d * tiny)
                if together or (low - beside <= e <= high + beside and count(e + beside) < j <= count(e - beside)):
                    found = (e, x)
                    break
            if count(mid) >= j:
                low = mid
            else:
                high = mid
        pairs.append(found)
    pairs.sort(key=lambda p: -p[0])
    out = []
    for e, x in pairs:
        if e * MAX_ROUNDING > tiny:
            out.append((e * scale, x * np.sign(x[np.abs(x).argmax()])))
    return out


# -- operator ----------------------------------------------------------------------------

def components(covariance: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """``(d, component, e, explained, axis)`` of each length, solved by one task a length."""
    def solve(block: pd.DataFrame) -> pd.DataFrame:
        rows = block.sort_values("i")["row"]
        v = np.frombuffer(b"".join(rows)).reshape(len(rows), -1)
        pairs = leading_eigenpairs(v, k)
        return pd.DataFrame({"d": [len(v)] * len(pairs), "component": range(1, len(pairs) + 1), "e": [e for e, _ in pairs],
                             "explained": [e / np.trace(v) for e, _ in pairs], "axis": [x.tobytes() for _, x in pairs]})

    return covariance.groupBy("d").applyInPandas(solve, "d int, component int, e double, explained double, axis binary")


def _model(fit: DataFrame, k: int) -> dict[int, dict]:
    """For each length: ``n``, ``s``, ``axes`` (length x components, over the square roots of their eigenvalues), ``explained``."""
    totals = sums(fit)
    model: dict[int, dict] = {}
    for r in components(products(fit, totals), k).orderBy("d", "component").collect():
        m = model.setdefault(r.d, {"n": totals[r.d][0], "s": totals[r.d][1], "axes": [], "explained": []})
        m["axes"].append(np.frombuffer(r.axis) / np.sqrt(r.e))
        m["explained"].append(r.explained)
    for m in model.values():
        m["axes"] = np.array(m["axes"]).T
    return model


def _identity_errors(fit: DataFrame, model: dict[int, dict]) -> dict[int, float]:
    """For each length the largest entry of the whitened fit list's covariance less the identity, measured on the list."""
    def partial(batches):
        total: dict[int, np.ndarray] = {}
        for x in unpacked(batches):
            if m := model.get(x.shape[1]):
                y = centred(x, m["n"], m["s"])[1] @ m["axes"]
                y = np.hstack([y, np.ones((len(y), 1))])  # the last column sums the entries themselves
                total[x.shape[1]] = total.get(x.shape[1], 0) + y.T @ y
        for d, g in total.items():
            a, b = np.indices(g.shape)
            yield pa.record_batch({"d": pa.array([d] * g.size, pa.int32()), "a": pa.array(a.ravel(), pa.int32()), "b": pa.array(b.ravel(), pa.int32()), "v": pa.array(g.ravel())})

    out: dict[int, float] = {}
    moments: dict[int, np.ndarray] = {}
    for r in fit.mapInArrow(partial, "d int, a int, b int, v double").groupBy("d", "a", "b").agg(F.sum("v").alias("v")).collect():
        k = model[r.d]["axes"].shape[1]
        moments.setdefault(r.d, np.zeros((k + 1, k + 1)))[r.a, r.b] = r.v / model[r.d]["n"]
    for d, g in moments.items():
        mean = g[-1, :-1]
        out[d] = float(np.abs(g[:-1, :-1] - np.outer(mean, mean) - np.eye(len(mean))).max())
    return out


def whiten(embeddings: DataFrame, k: int = COMPONENTS, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each row of ``embeddings`` that takes part and each of its up to ``k`` components:
    ``id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error`` (see the module)."""
    fit = written(fit_list(embeddings, vector), "whitening-fit")
    model = _model(fit, k)
    errors = _identity_errors(fit, model)

    def project(batches):
        for batch in batches:
            ids = batch.column(0)
            for rows, x in integers(batch.column(1)):
                m = model.get(x.shape[1])
                if m is None or not len(rows):
                    continue
                exact, c = centred(x, m["n"], m["s"])
                bound = x.shape[1] * max(int(exact.max()), -int(exact.min())) ** 2
                deviation = (_whole(exact, bound) ** 2).sum(axis=1)
                deviation = [int(v) if v < _LONG else None for v in deviation]
                y = c @ m["axes"]
                kept = y.shape[1]
                yield pa.record_batch({
                    id: ids.take(pa.array(np.repeat(rows, kept))), "component": pa.array(np.tile(np.arange(1, kept + 1), len(rows)), pa.int32()),
                    "n": pa.array(np.full(kept * len(rows), m["n"]), pa.int64()), "deviation": pa.array(np.repeat(deviation, kept).tolist(), pa.int64()),
                    "whitened": pa.array(y.ravel()), "explained": pa.array(np.tile(m["explained"], len(rows))),
                    "identity_error": pa.array(np.full(kept * len(rows), errors[x.shape[1]]))})

    kind = dict(embeddings.dtypes)[id]
    return embeddings.select(id, vector).mapInArrow(
        project, f"`{id}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
