"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Rows are kept as blocks of whole numbers.  Every step of the bidiagonalisation is one pass
over the blocks that takes ``X z`` of the centred rows and ``X' (X z)``; vectors as long as
the table never leave their tasks, because a left vector ``u = X w`` is known by its ``w``.
The driver holds vectors as long as an embedding: the right vectors, which are fully
orthogonalised, the ``w`` of the left ones, and the bidiagonal matrix, whose small singular
value decomposition gives components and deviations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

FACTOR, OFFSET = 1024, 100_000
#: Larger entries count as this one, so that sums of a block fit a long.
LARGEST = float(1 << 35)
COMPONENTS = 8
#: Numbers in a block.
CELLS = 1 << 20
#: A residual or a new direction is nothing below this share of the largest singular value.
CONVERGED, NOTHING = 1e-14, 1e-11


def _packed(id_type: pa.DataType):
    """Blocks of rows whose vector is whole and finite: ids, lengths, and all entries as longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = pc.list_flatten(vectors).to_numpy(zero_copy_only=False).astype(np.float64)  # null entries become NaN
            owner = np.repeat(np.arange(len(sizes)), sizes)
            fine = pc.is_valid(vectors).to_numpy(zero_copy_only=False) & (np.bincount(owner, ~np.isfinite(values), len(sizes)) == 0)
            values = values[fine[owner]]
            x = np.floor(FACTOR * np.clip(values, -LARGEST, LARGEST)).astype(np.int64) + OFFSET
            ids, sizes = batch.column("id").filter(pa.array(fine)), sizes[fine]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            step = max(1, CELLS // max(1, int(sizes.max(initial=1))))
            for a in range(0, len(sizes), step):
                b = min(len(sizes), a + step)
                own = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), ids.slice(a, b - a).cast(id_type))
                lengths = pa.array([sizes[a:b].tolist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([own, lengths, pa.array([x[ends[a] : ends[b]].tobytes()], pa.binary())], ["ids", "sizes", "x"])

    return run


def _matrix(batch: pa.RecordBatch, i: int, width: int) -> np.ndarray:
    """Rows of a block as longs; what short vectors lack is an entry of 0."""
    sizes = np.asarray(batch.column("sizes")[i].as_py(), np.int64)
    flat = np.frombuffer(batch.column("x")[i].as_py(), np.int64)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.full((len(sizes), width), OFFSET, np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


class Centre:
    """The mean as whole and remaining part, so that centring loses nothing."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.width = n, len(sums)
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def rows(self, batch: pa.RecordBatch, i: int) -> np.ndarray:
        return (_matrix(batch, i, self.width) - self.whole) - self.rest / self.n

    def deviations(self, batch: pa.RecordBatch, i: int) -> list[int | None]:
        """Sums of (n x - S)^2 over the dimensions, exact; None beyond a long."""
        away = _matrix(batch, i, self.width) - self.whole
        bound = (int(np.abs(away).max(initial=0)) + 1) * self.n
        if bound * bound * self.width < 1 << 63:
            away = self.n * away - self.rest
            return (away * away).sum(1).tolist()
        found = (sum((self.n * a - r) ** 2 for a, r in zip(row, self.rest.tolist(), strict=True)) for row in away.tolist())
        return [d if d < 1 << 63 else None for d in found]


def _added(blocks: DataFrame, part: Callable[[pa.RecordBatch, int], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``part`` over all blocks: added up within tasks, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for i in range(batch.num_rows):
                total += part(batch, i)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], ["at", "value"])

    rows = blocks.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros(size)
    for r in rows.collect():  # ``size`` rows, a few times an embedding's length
        out[r["at"]] = r["value"]
    return out


def _totals(blocks: DataFrame, width: int) -> list[int]:
    """Sum of every dimension, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for batch in batches:
            for i in range(batch.num_rows):
                total = [a + b for a, b in zip(total, _matrix(batch, i, width).sum(0).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(map(Decimal, total)), pa.decimal128(38, 0))], ["at", "value"])

    rows = blocks.mapInArrow(run, "at int, value decimal(38,0)").groupBy("at").agg(F.sum("value").alias("value"))
    found = {r["at"]: int(r["value"]) for r in rows.collect()}
    return [found[i] for i in range(width)]


def products(blocks: DataFrame, centre: Centre) -> Callable[[np.ndarray, np.ndarray], tuple[float, np.ndarray, np.ndarray]]:
    """For ``z`` and ``w``: of s = X z its square, its products with X w, and X' s, in one pass."""

    def at(z: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def part(batch: pa.RecordBatch, i: int) -> np.ndarray:
            x = centre.rows(batch, i)
            s = x @ z
            g = s @ x
            return np.concatenate([[s @ s], g, (s @ x) @ w if w.shape[1] else []])

        out = _added(blocks, part, 1 + centre.width + w.shape[1])
        return float(out[0]), out[1 + centre.width :], out[1 : 1 + centre.width]

    return at


def _apart(r: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """``r`` without its parts along orthonormal columns; twice is enough."""
    for _ in range(2):
        for b in bases:
            r = r - b @ (b.T @ r)
    return r


def bidiagonalise(product, width: int, most: int, wanted: int, known: np.ndarray, bar: float = 0.0, seed: int = 7) -> tuple[np.ndarray, np.ndarray, bool]:
    """Largest singular values and right vectors of X outside the orthonormal columns ``known``, and whether nothing is left.

    Runs until the ``wanted`` largest have residuals of nothing, until the largest lies
    below ``bar`` with its residual, or until ``most`` directions are used up.  A direction
    that ends the recurrence is followed by a new one across all former ones, which finds
    further copies of a repeated value.
    """
    rng = np.random.default_rng(seed)
    v, w, g = np.zeros((width, 0)), np.zeros((width, 0)), np.zeros((width, 0))
    alpha: list[float] = []
    beta: list[float] = []

    def fresh() -> np.ndarray:
        r = _apart(rng.normal(size=width), known, v)
        return r / np.linalg.norm(r)

    new, size = fresh(), 0.0
    while True:
        z = new - (beta[-1] * w[:, -1] if beta else 0.0)
        square, along, back = product(z, w)
        # Full orthogonalisation of the left vector X z, through the w of all former ones.
        z, back = z - w @ along, back - g @ along
        a = float(np.sqrt(max(0.0, square - along @ along)))
        size = max(size, a)
        a = a if a > NOTHING * size else 0.0
        v = np.column_stack([v, new])
        w = np.column_stack([w, z / a if a else np.zeros(width)])
        g = np.column_stack([g, back / a if a else np.zeros(width)])
        alpha.append(a)
        r = _apart(g[:, -1] - a * new, known, v)
        b = float(np.linalg.norm(r))
        size = max(size, b)
        left, values, right = np.linalg.svd(np.diag(alpha) + np.diag(beta, 1))
        residual = b * np.abs(left[-1])
        full = len(alpha) == most
        done = len(values) >= wanted and (residual[:wanted] <= CONVERGED * size).all()
        if full or done or values[0] + residual[0] < bar:
            k = min(wanted, len(values))
            return values[:k], v @ right[:k].T, full
        if b > NOTHING * size:
            new = r / b
            beta.append(b)
        else:
            new = fresh()
            beta.append(0.0)


def components(product, width: int, n: int, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest singular values of X and their right vectors, values of nothing left out.

    One run of the recurrence meets one copy of a repeated value; unless it used up all
    directions, further runs look for larger ones outside of what is found.
    """
    values, vectors, full = bidiagonalise(product, width, min(width, n), wanted, np.zeros((width, 0)))
    while not full and vectors.shape[1] < width:
        more, across, full = bidiagonalise(product, width, min(width, n) - vectors.shape[1], wanted, vectors, bar=values[min(wanted, len(values)) - 1] * (1 - 1e-9), seed=11 + len(values))
        larger = more > values[min(wanted, len(values)) - 1] * (1 - 1e-9)
        if not larger.any():
            break
        values, vectors = np.concatenate([values, more[larger]]), np.column_stack([vectors, across[:, larger]])
    order = np.argsort(-values, kind="stable")[:wanted]
    order = order[values[order] > NOTHING * max(values.max(initial=0.0), 1.0)]
    return values[order], np.linalg.qr(vectors[:, order])[0]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every vector and component.

    Rows whose vector is null or holds null or non-finite entries are dropped.  An entry c
    counts as the long floor(1024 c) + 100000 (beyond 2^35 as that); vectors shorter than
    the longest one are taken to end in zeros.  All remaining rows are fitted and
    transformed, repeated ones and those with null or repeated ids too.  Components are
    unit eigenvectors of the covariance (divisor n), numbered from 1 by falling
    eigenvalue; those without variance are left out, so a table of equal vectors, of one
    or of none gives no row.  ``deviation`` is exact, null beyond a long.  Other columns are
    not read, whatever their names.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    kind = rows.schema["id"].dataType.simpleString()
    id_type = rows.limit(0).toArrow().schema.field("id").type
    blocks = table(rows.mapInArrow(_packed(id_type), f"ids array<{kind}>, sizes array<int>, x binary"))
    n, width = blocks.agg(F.sum(F.size("ids")), F.max(F.array_max("sizes"))).first()
    out = f"{id_col} {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if not n or not width:
        return vectors.sparkSession.createDataFrame([], out)
    centre = Centre(n, _totals(blocks, width))
    spread = float(_added(blocks, lambda batch, i: np.array([(centre.rows(batch, i) ** 2).sum()]), 1)[0])
    if not spread:
        return vectors.sparkSession.createDataFrame([], out)
    values, axes = components(products(blocks, centre), width, n, wanted)
    k = len(values)
    scaled = axes * (np.sqrt(n) / values)
    explained = values * values / spread

    def moments(batch: pa.RecordBatch, i: int) -> np.ndarray:
        y = centre.rows(batch, i) @ scaled
        return np.concatenate([y.sum(0), (y.T @ y).ravel()])

    moment = _added(blocks, moments, k + k * k) / n
    error = float(np.abs(moment[k:].reshape(k, k) - np.outer(moment[:k], moment[:k]) - np.eye(k)).max(initial=0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
        for batch in batches:
            for i in range(batch.num_rows):
                y = centre.rows(batch, i) @ scaled
                every = np.repeat(np.arange(len(y)), k)
                ids = batch.column("ids")[i].values.take(pa.array(every))
                away = pa.array(centre.deviations(batch, i), pa.int64()).take(pa.array(every))
                columns = [ids, pa.array(np.tile(np.arange(1, k + 1), len(y)), pa.int32()), pa.array(np.full(y.size, n)), away, pa.array(y.ravel()), pa.array(np.tile(explained, len(y))), pa.array(np.full(y.size, error))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return blocks.mapInArrow(run, out)
