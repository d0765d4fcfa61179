"""Near-duplicate vectors by an exact metric range join.

Unit vectors lie within a Euclidean distance of sqrt(2 - 2 * cosine).  Pivots split them
into cells; by the triangle inequality a vector can have a partner in a cell only if its
distance to the cell's pivot is at most the cell's radius plus the range, and at most its
distance to its own pivot plus twice the range, so it is compared with those cells alone.
Cells are cut into blocks of bounded size, a row each, and blocks in range of each other are
compared in pairs that are read from one table, so a dense cell spreads over many tasks and
disk grows with the vectors, not with their pairs.  Equal vectors are one point with a weight.
A pair of blocks counts links and emits a spanning forest of them, never the links themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, table
from .components import connected_components

#: Vectors for each pivot, most pivots, and about the rows of a block; bytes of a point's name.
PER_PIVOT, MOST_PIVOTS, TILE, NAME = 4096, 2048, 4096, 16
_SLACK = 1e-6


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * (x @ pivots.T)))


def _homes(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = _distances(_unit(_matrix(batch.column("vector"))), pivots)
                home = d.argmin(axis=1)
                columns = [*batch.columns, pa.array(home, pa.int32()), pa.array(d[np.arange(len(home)), home])]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "home", "reach"])

    return run


def _block(pivots: np.ndarray, radii: np.ndarray, reach: float):
    """One row of a cell's part: the cells that some of its points have in range, and names, vectors and weights as bytes."""

    def run(part: pa.Table) -> pa.Table:
        vectors = _matrix(part["vector"].combine_chunks())
        d = _distances(_unit(vectors), pivots)
        home = np.full(len(d), part["home"][0].as_py())
        near = np.flatnonzero(_near(d, home, radii, reach).any(axis=0))
        flat = part["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        columns = {
            "block": pa.array([int(home[0]) << 32 | part["part"][0].as_py()], pa.int64()), "cell": pa.array(home[:1], pa.int32()), "near": pa.array([near], pa.list_(pa.int32())),
            "points": pa.array([b"".join(part["point"].to_pylist())]), "vectors": pa.array([flat.tobytes()]), "weights": pa.array([part["weight"].to_numpy().tobytes()]),
        }
        return pa.table(columns)

    return run


def _near(d: np.ndarray, home: np.ndarray, radii: np.ndarray, reach: float) -> np.ndarray:
    own = d[np.arange(len(home)), home][:, None]
    return (d <= radii[None, :] + reach) & (d <= own + 2 * reach)


def _pair_links(pivots: np.ndarray, radii: np.ndarray, reach: float, least: float, kind: str):
    """Weighted link counts of the points of two blocks, from either side, and a spanning forest of the links."""

    def side(row: dict, s: str) -> tuple:
        names = np.frombuffer(row[f"points_{s}"], f"V{NAME}")
        x = _unit(np.frombuffer(row[f"vectors_{s}"], kind).astype(np.float64).reshape(len(names), -1))
        return names, x, np.frombuffer(row[f"weights_{s}"], np.int64)

    def toward(x: np.ndarray, home: int, cell: int) -> np.ndarray:
        """Points that may have a partner in a cell."""
        if home == cell:
            return np.arange(len(x))
        d = _distances(x, pivots[[home, cell]])
        return np.flatnonzero(_near(d, np.zeros(len(x), int), radii[[home, cell]], reach)[:, 1])

    def linked(one: tuple, other: tuple, same: bool) -> pa.RecordBatch | None:
        (names_a, x, weight_a), (names_b, y, weight_b) = one, other
        n = len(x)
        label, counts = np.arange(n + (0 if same else len(y))), np.zeros(n + (0 if same else len(y)), np.int64)
        y32 = y.astype(np.float32).T.copy()
        for i in range(0, n, 1024):
            a, b = np.nonzero(x[i : i + 1024].astype(np.float32) @ y32 >= least - 1e-4)
            a += i
            for j in range(0, len(a), 200_000):
                p, q = a[j : j + 200_000], b[j : j + 200_000]
                ok = np.einsum("ij,ij->i", x[p], y[q]) >= least
                if same:
                    ok &= p != q
                p, q = p[ok], q[ok]
                np.add.at(counts, p, weight_b[q])
                if not same:
                    np.add.at(counts, n + q, weight_a[p])
                label = _merge(label, p, q if same else n + q)
        found = np.flatnonzero(counts)
        if not len(found):
            return None
        names = names_a if same else np.concatenate([names_a, names_b])
        binary = lambda v: pa.array(v.tolist(), pa.binary())
        return pa.RecordBatch.from_arrays([binary(names[found]), pa.array(counts[found]), binary(names[label[found]])], ["point", "links", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, one = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["block_a"] != held:
                    held, one = row["block_a"], side(row, "a")
                same, cells = row["block_a"] == row["block_b"], (row["cell_a"], row["cell_b"])
                other = one if same else side(row, "b")
                kept = [tuple(v[toward(points[1], *c)] for v in points) for points, c in ((one, cells), (other, cells[::-1]))]
                out = linked(*kept, same) if all(len(k[0]) for k in kept) else None
                if out is not None:
                    yield out

    return run


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (smallest member) after joining the components of a and b, all flat again."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return label
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, label[label]):
            label = label[label]


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9) -> DataFrame:
    """``(id_col, n_links, component_id, kept)``, one row per input row.

    Vectors link if their cosine, in double precision, is at least ``cosine`` (0.2 or more).
    Null, empty and zero vectors and those with null or non-finite components link with
    nothing; so do vectors of different lengths.  Rows with a null id link with nothing,
    have a null component and are kept.  Rows that repeat an id count as vectors of their
    own.  Other columns are ignored; an empty table gives no rows.
    """
    v = F.col("vector")
    fit = (F.size(v) > 0) & ~F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) & F.exists(v, lambda e: e != 0)
    # Single precision is kept where the table has it, as half the bytes.
    single = dict(vectors.dtypes)[vector_col] == "array<float>"
    base = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<float>" if single else "array<double>").alias("vector"))
    base = base.withColumn("good", F.coalesce(F.col("id").isNotNull() & fit, F.lit(False)))
    key = F.sha2(F.concat_ws(",", F.col("vector").cast("array<string>")), 256)
    base = base.withColumn("point", F.when(F.col("good"), F.unhex(F.substring(key, 1, 2 * NAME))))
    rows = table(base.select("id", "point"))
    counted = rows.where("point is not null").groupBy("point").agg(F.count(F.lit(1)).alias("weight"), F.min("id").alias("id"))
    firsts = base.where("point is not null").groupBy("point").agg(F.count(F.lit(1)).alias("weight"), F.first("vector").alias("vector"))
    points = table(firsts.select("point", "vector", "weight", F.xxhash64("point").alias("spread")))
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + _SLACK
    links = None
    # Vectors of different lengths are compared only among themselves.
    lengths = [r[0] for r in points.groupBy(F.size("vector")).count().orderBy("count", ascending=False).limit(1001).collect()]
    if len(lengths) > 1000:
        raise ValueError("more than 1000 vector lengths")
    for length in lengths:
        some = _links(points.where(F.size("vector") == length), reach, cosine, "f4" if single else "f8")
        links = some if links is None else links.unionByName(some)
    if links is None:
        found = rows.select("point", F.lit(0).cast("bigint").alias("links"), F.col("point").alias("component")).limit(0)
        degrees = found.select("point", "links")
        components = found.select("point", "component")
    else:
        links = table(links.groupBy("point", "other").agg(F.sum("links").alias("links")))
        degrees = links.groupBy("point").agg(F.sum("links").alias("links"))
        components = connected_components(links.select(F.col("point").alias("a"), F.col("other").alias("b"))).select(F.col("node").alias("point"), "component")
    named = counted.join(degrees, "point", "left").join(components, "point", "left").select("point", "id", "weight", "links", F.coalesce("component", "point").alias("component"))
    named = cut(named)
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    of = named.join(least, "component").select("point", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), "component_id")
    component = F.coalesce("component_id", "id")
    return rows.select("id", "point").join(of, "point", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == component)).alias("kept"),
    )


def _links(points: DataFrame, reach: float, cosine: float, kind: str) -> DataFrame:
    total = points.count()
    k = int(min(MOST_PIVOTS, max(1, -(-total // PER_PIVOT))))
    # At most MOST_PIVOTS vectors, those with the smallest hashes.
    drawn = points.orderBy("spread", "point").limit(k).select("vector").collect()
    pivots = _unit(np.array([r[0] for r in drawn], np.float64))
    homes = points.select("vector").mapInArrow(_homes(pivots), f"vector {dict(points.dtypes)['vector']}, home int, reach double")
    radii, natives = np.zeros(k), np.zeros(k, np.int64)
    for r in homes.groupBy("home").agg(F.max("reach"), F.count(F.lit(1))).collect():
        radii[r[0]], natives[r[0]] = r[1], r[2]
    parts = F.element_at(F.lit([max(1, -(-int(n) // TILE)) for n in natives]), F.col("home") + 1)
    placed = points.mapInArrow(_homes(pivots), ", ".join(f"{c} {t}" for c, t in points.dtypes) + ", home int, reach double")
    placed = placed.select("point", "vector", "weight", "home", F.pmod(F.shiftrightunsigned("spread", 20), parts).cast("int").alias("part"))
    schema = "block bigint, cell int, near array<int>, points binary, vectors binary, weights binary"
    blocks = table(placed.groupBy("home", "part").applyInArrow(_block(pivots, radii, reach), schema))
    a, b = (blocks.select(*(F.col(c).alias(f"{c}_{s}") for c in blocks.columns)) for s in "ab")
    in_range = F.array_contains("near_a", F.col("cell_b")) & F.array_contains("near_b", F.col("cell_a"))
    # Every task reads its part of the blocks from the table: no vector is shuffled once for every cell in its range.
    pairs = a.hint("shuffle_replicate_nl").join(b, (F.col("block_a") <= F.col("block_b")) & in_range).drop("near_a", "near_b")
    return pairs.mapInArrow(_pair_links(pivots, radii, reach, cosine, kind), "point binary, links bigint, other binary")
