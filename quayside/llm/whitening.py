"""Whitening of whole-number vectors along the leading eigenvectors of their covariance.

The covariance is summed up in tasks from vectors less their rounded mean, in whole numbers, so it is exact
before its one division. The driver gets the upper triangle of a square as wide as the vectors. Its
eigenvectors in float32 are corrected by the iteration of Ogita and Aishima (2018), matrix products in extended
precision (as wide as the machine's long double) that double the right digits each time. Eigenvalues too close
for the digits at hand are one cluster, whose part of the matrix, less its mean eigenvalue, is solved by itself
(Ogita and Aishima 2019).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import ROW, give_back, packed
from quayside.llm.vectors import padded, summed, triangle

COMPONENTS = 8
MAX_STEPS = 20
_WHOLE = "decimal(38,0)"
_WIDE = np.longdouble


@dataclass(frozen=True)
class Whitening:
    """``sums`` are exact, ``base`` is the rounded mean; ``axes`` has a component in each column, by falling
    ``values``; ``solid`` counts those whose variance is more than rounding."""

    width: int
    n: int
    sums: list[int]
    base: np.ndarray
    axes: np.ndarray
    values: np.ndarray
    total: float
    solid: int
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n times a vector less the sum of all: whole numbers, Python's own where 64 bits are too few."""
        rest = np.array([s - self.n * int(b) for s, b in zip(self.sums, self.base, strict=True)], dtype=object)
        z = x - self.base
        if self.n * (int(np.abs(z).max(initial=0)) + 1) >= 2**62:
            return self.n * z.astype(object) - rest
        return self.n * z - rest.astype(np.int64)

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened values of centred vectors, for the solid components."""
        return (y.astype(np.float64) / self.n) @ self.axes[:, : self.solid] / np.sqrt(self.values[: self.solid])


def exact_sums(x: np.ndarray) -> np.ndarray:
    """Sums by column, in Python's whole numbers."""
    fits = (int(np.abs(x).max(initial=0)) + 1) * len(x) < 2**62
    return x.sum(axis=0).astype(object) if fits else x.astype(object).sum(axis=0)


def exact_gram(z: np.ndarray) -> np.ndarray:
    """Upper triangle of the sum of z z^T, in Python's whole numbers."""
    largest = int(np.abs(z).max(initial=0)) + 1
    upper = np.triu_indices(z.shape[1])
    total = np.zeros(len(upper[0]), object)
    if largest > 2**26:
        whole = z.astype(object)
        return total + (whole.T @ whole)[upper]
    step = max(1, 2**53 // largest**2)
    for at in range(0, len(z), step):
        part = z[at : at + step].astype(np.float64)
        total += (part.T @ part)[upper].astype(np.int64).astype(object)
    return total


def refined_eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors in columns of a symmetric matrix of long doubles."""
    d = len(a)
    scale = np.abs(a).max(initial=0)
    if not d or scale == 0:
        return np.zeros(d, _WIDE), np.eye(d, dtype=_WIDE)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(_WIDE)
    eye, norm = np.eye(d, dtype=_WIDE), np.linalg.norm(a.astype(np.float64), 2)
    before = np.inf
    for _ in range(MAX_STEPS):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        off = (s - np.diag(values)).astype(np.float64)
        unsure = 2 * (np.linalg.norm(off, 2) + norm * np.linalg.norm(r.astype(np.float64), 2))
        unsure = max(unsure, 16 * d * norm * float(np.finfo(_WIDE).eps))
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= unsure
        e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gap))
        x = x + x @ e
        change = float(np.abs(e).max())
        for cluster in _clusters(values, unsure):
            change = max(change, _solve_cluster(a, x, values, cluster))
        if change <= 2.0**-58 or change >= before <= 2.0**-50:
            break
        before = change
    x = x + x @ (eye - x.T @ x) / 2
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


def _clusters(values: np.ndarray, unsure: float) -> list[np.ndarray]:
    """Groups of two or more eigenvalues, each within ``unsure`` of the next one."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > unsure) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def _solve_cluster(a: np.ndarray, x: np.ndarray, values: np.ndarray, cluster: np.ndarray) -> float:
    """Turn the cluster's vectors, in place, to the eigenvectors of their own part of ``a``; returns by how much.

    Less the mean eigenvalue the part is as small as the cluster is narrow, and so is its error in double."""
    own = x[:, cluster]
    middle = values[cluster].mean()
    part = own.T @ (a @ own - middle * own)
    part = (part + part.T) / 2
    size = np.abs(part).max()
    if size <= 2.0**-60:
        return 0.0
    turn = np.linalg.eigh((part / size).astype(np.float64))[1]
    # The order and signs nearest to what is there, so that a settled cluster stays as it is.
    place = np.argmax(np.abs(turn), axis=0)
    if len(set(place.tolist())) == len(place):
        turn = turn[:, np.argsort(place)]
    turn = turn * np.where(np.diag(turn) < 0, -1.0, 1.0)
    x[:, cluster] = own @ turn.astype(_WIDE)
    return float(np.abs(turn - np.eye(len(cluster))).max())


def fit_whitening(vectors: DataFrame, x_col: str, components: int = COMPONENTS) -> Whitening:
    """Mean, covariance and leading components of all vectors.

    ``x_col`` is an array of whole numbers below 2^51 in amount, null for a row that takes no part. Vectors of
    another length than the commonest (of several, the longest) take none either. Without vectors there
    are no components. Repeated rows and ids count as often as they stand there. Three passes over
    the column, none of which sends more to the driver than a square as wide as the vectors.
    """
    sized = vectors.filter(F.col(x_col).isNotNull()).groupBy(F.size(x_col).alias("width")).agg(F.count(F.lit(1)).alias("n"))
    found = sized.orderBy(F.desc("n"), F.desc("width")).first()
    width, n = (0, 0) if found is None else (found["width"], found["n"])
    if not width:
        return Whitening(0, n, [], np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0), 0.0, 0, 0.0)
    own = vectors.filter(F.size(x_col) == width)
    sums = [int(v) for v in summed(own, x_col, width, exact_sums, _WHOLE)]
    base = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    gram = summed(own, x_col, width, lambda x: exact_gram(x - base), _WHOLE)
    rest = [s - n * int(b) for s, b in zip(sums, base, strict=True)]
    i, j = np.triu_indices(width)
    exact = [n * int(g) - rest[p] * rest[q] for g, p, q in zip(gram, i.tolist(), j.tolist(), strict=True)]
    covariance = triangle([_WIDE(v) for v in exact], width, _WIDE) / (_WIDE(n) * _WIDE(n))
    values, axes = refined_eigen(covariance)
    total = float(np.trace(covariance))
    axes = axes[:, :components].astype(np.float64)
    values = np.maximum(values[:components].astype(np.float64), 0.0)
    largest = np.argmax(np.abs(axes), axis=0)
    axes = axes * np.where(axes[largest, np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    solid = int((values > width * np.finfo(np.float64).eps * total).sum())
    model = Whitening(width, n, sums, base, axes, values, total, solid, 0.0)
    if not solid:
        return model

    def moments(x: np.ndarray) -> np.ndarray:
        w = model.project(model.centred(x))
        return np.concatenate([w.sum(axis=0), (w.T @ w)[np.triu_indices(solid)]])

    found = np.array(summed(own, x_col, width, moments, "double"))
    mean = found[:solid] / n
    spread = triangle(found[solid:] / n, solid, np.float64) - np.outer(mean, mean)
    error = float(np.abs(spread - np.eye(solid)).max())
    return Whitening(width, n, sums, base, axes, values, total, solid, error)


def whiten(vectors: DataFrame, model: Whitening, x_col: str) -> DataFrame:
    """One row per vector and component: the other columns of ``vectors`` in the struct ``_qs_row``, whatever
    their names are, and component, n, deviation, whitened, explained, identity_error.

    Rows that took no part in the fit give no rows. A component without variance has whitened null and
    explained 0, or null if nothing varies at all; identity_error is over the others. A deviation beyond 63
    bits is null.
    """
    given = vectors.filter(F.size(x_col) == (model.width or -1)).select(x_col, packed(vectors, x_col))
    row_type = given.schema[ROW].dataType.simpleString()
    shown = model.axes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y = model.centred(padded(batch.column(0), model.width))
            if model.width * (int(np.abs(y).max()) + 1) ** 2 < 2**62:
                far = (y.astype(np.int64) ** 2).sum(axis=1).tolist()
            else:
                far = [int(v) if v < 2**63 else None for v in (y.astype(object) ** 2).sum(axis=1)]
            flat = np.full((len(y), shown), np.nan)
            flat[:, : model.solid] = model.project(y)
            values = pa.array(flat.ravel(), from_pandas=True)
            at = pa.array(np.arange(0, flat.size + 1, max(shown, 1), dtype=np.int32)[: len(y) + 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(far, pa.int64()), pa.ListArray.from_arrays(at, values)], names=[ROW, "deviation", "w"]
            )
        give_back()

    found = given.mapInArrow(run, f"{ROW} {row_type}, deviation bigint, w array<double>")
    shares = F.array(*[F.lit(float(v) / model.total if model.total else None).cast("double") for v in model.values])
    return found.select("*", F.posexplode("w").alias("at", "whitened")).select(
        ROW,
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        (F.get(shares, F.col("at")) if shown else F.lit(None).cast("double")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
