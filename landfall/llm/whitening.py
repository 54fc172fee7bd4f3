"""Whitened embeddings: projections on the leading components of their covariance, scaled to unit variance."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.spectrum import leading

COMPONENTS = 32
STEPS, ZERO = 64, 1_000_000
# Beyond this an entry times 64 is no 64-bit integer.
LARGEST = float(1 << 56)
LONG = 1 << 63
ROWS = 1024


@dataclass(frozen=True)
class Fit:
    """What is known of the vectors of one size: their count, sums, components, and shares of the variance."""

    n: int
    sums: tuple[int, ...]
    project: np.ndarray | None = None
    explained: np.ndarray | None = None
    identity_error: float = 0.0
    whole: np.ndarray = field(init=False)
    rest: np.ndarray = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "whole", np.array([s // self.n for s in self.sums], np.int64))
        object.__setattr__(self, "rest", np.array([s % self.n for s in self.sums], np.int64))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: whole numbers are taken off as such, so that nothing is rounded before the last step."""
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sums of (n * x - S)**2, exact; null where that is beyond a long."""
        apart = x - self.whole
        if (self.n * (float(np.abs(apart).max(initial=0)) + 1)) ** 2 * len(self.whole) < LONG:
            return pa.array(((self.n * apart - self.rest) ** 2).sum(axis=1))
        exact = ((self.n * apart.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1)
        return pa.array([v if v < LONG else None for v in exact.tolist()], pa.int64())


def entries(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and whole-number vectors of the rows that remain, apart for each size of vector, in slices of some rows."""
    batch = batch.filter(pc.is_valid(batch.column("vector")))
    column, ids = batch.column("vector"), batch.column("vec_id")
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        for k in range(0, len(rows), ROWS):
            own = rows[k : k + ROWS]
            vectors = values[starts[own][:, None] + np.arange(size)]
            sound = (np.abs(vectors) < LARGEST).all(axis=1)
            if sound.any():
                x = np.floor(STEPS * vectors[sound]).astype(np.int64) + ZERO
                yield ids.take(pa.array(own[sound])), x


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, sums = {}, {}
    for batch in batches:
        for _, x in entries(batch):
            size = x.shape[1]
            small = float(np.abs(x).max()) * len(x) < LONG / 2
            own = x.sum(axis=0).astype(object) if small else x.astype(object).sum(axis=0)
            counts[size], sums[size] = counts.get(size, 0) + len(x), sums.get(size, 0) + own
    for size, totals in sums.items():
        columns = [
            pa.array([size] * size, pa.int32()),
            pa.array(range(size), pa.int32()),
            pa.array([counts[size]] * size, pa.int64()),
            pa.array([Decimal(int(t)) for t in totals], pa.decimal128(38, 0)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["size", "place", "n", "total"])


def _products(of: Callable[[np.ndarray], np.ndarray]) -> Callable:
    """Sums of the products of all pairs of entries of ``of(x)``, a row of the matrix a row, once for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in entries(batch):
                y = of(x)
                found[x.shape[1]] = found.get(x.shape[1], 0) + y.T @ y
        for size, matrix in found.items():
            columns = [pa.array([size] * len(matrix), pa.int32()), pa.array(range(len(matrix)), pa.int32())]
            columns.append(pa.array([row.tobytes() for row in matrix], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["size", "place", "row"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for size, place, row in zip(*(batch.column(c).to_pylist() for c in ("size", "place", "row"))):
            found[size, place] = found.get((size, place), 0) + np.frombuffer(row)
    if found:
        columns = [pa.array([key[k] for key in found], pa.int32()) for k in range(2)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([r.tobytes() for r in found.values()], pa.binary())], ["size", "place", "row"])


def _matrices(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """The matrix for each size, added up in tasks that own some of its rows; it alone comes to the driver."""
    kinds = "size int, place int, row binary"
    parts = rows.mapInArrow(_products(of), kinds).repartition("size", "place").mapInArrow(_added, kinds)
    found: dict[int, dict[int, np.ndarray]] = {}
    for r in parts.collect():
        found.setdefault(r["size"], {})[r["place"]] = np.frombuffer(r["row"])
    return {size: np.stack([own[k] for k in sorted(own)]) for size, own in found.items()}


def fitted(rows: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """The fit for each size of vector: four reads of ``rows``, of which sums and square matrices come to the driver."""
    sums = rows.mapInArrow(_sums, "size int, place int, n bigint, total decimal(38,0)")
    sums = sums.groupBy("size", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    fits: dict[int, Fit] = {}
    for size in {r["size"] for r in sums}:
        own = sorted((r for r in sums if r["size"] == size), key=lambda r: r["place"])
        fits[size] = Fit(int(own[0]["n"]), tuple(int(r["total"]) for r in own))
    start = dict(fits)
    for size, matrix in _matrices(rows, lambda x: start[x.shape[1]].centred(x)).items():
        covariance = (matrix + matrix.T) / (2 * fits[size].n)
        values, vectors = leading(covariance, components)
        total = np.trace(covariance)
        fits[size] = replace(fits[size], project=vectors / np.sqrt(values), explained=values / (total or 1.0))
    turned = dict(fits)
    for size, matrix in _matrices(rows, lambda x: turned[x.shape[1]].centred(x) @ turned[x.shape[1]].project).items():
        error = np.abs(matrix / fits[size].n - np.eye(len(matrix))).max(initial=0.0)
        fits[size] = replace(fits[size], identity_error=float(error))
    return fits


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component, up to ``components`` of them, numbered from 1 by falling variance.

    ``vectors`` has ``vec_id`` and ``embedding``; other columns do not matter.  Entries c count as
    x = floor(64 * c) + 1000000.  Returns ``vec_id``, ``component``, ``n`` (vectors of the fit),
    ``deviation`` (the sum of (n * x - S)**2, exact; null beyond a long), ``whitened`` (x - S / n projected on the
    component, over its standard deviation), ``explained`` (its share of the variance) and ``identity_error``
    (the largest entry of the measured covariance of ``whitened`` less the identity).

    Left out are vectors that are null or hold a null or non-finite entry or one of 2**56 or more, and,
    having no component, empty ones and components without variance (equal vectors, a single one,
    fewer vectors than components).  Repeated rows and null ids count and stay like any other.  Vectors of
    another size make a fit of their own.  A matrix of the square of a size comes to the driver.
    """
    vector = F.col("embedding").cast("array<double>").alias("vector")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector)
    fits = fitted(rows, components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in entries(batch):
                fit = fits[x.shape[1]]
                k = fit.project.shape[1]
                each = pa.array(np.repeat(np.arange(len(x)), k))
                columns = [
                    ids.take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), fit.n)),
                    fit.deviations(x).take(each),
                    pa.array((fit.centred(x) @ fit.project).ravel()),
                    pa.array(np.tile(fit.explained, len(x))),
                    pa.array(np.full(len(each), fit.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, NAMES)

    return rows.mapInArrow(run, KINDS)


NAMES = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
KINDS = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
