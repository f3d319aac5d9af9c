"""Embedding whitening by polarisation.

Entries are made integers, so every sum is exact: c becomes floor(64 * c) + 1000000.
The fit list is each distinct vector once. Around whole centres (the mean rounded down)
the squares of each dimension and of each sum of two dimensions are added up exactly, and
corrected, in whole numbers still, for what the centres differ from the means. Half the
difference of the variance of a sum and of its two parts' variances is their covariance.
Only then are the numbers divided, once and correctly rounded, and the matrix given to
``eigh``. Components come by falling eigenvalue; the entry of largest size in each is made
positive, so that runs agree. A component whose eigenvalue is nothing but rounding is left
out, so a fit list of one vector has none.

The driver sees one number per dimension and per pair of dimensions, the model is as
large; both are bounded by the dimensions, of which more than ``MAX_DIMENSIONS`` are an
error. Tasks add up before they pass anything on: a row per dimension or pair and task.

Nulls: rows whose vector is null, empty or has a null or non-finite entry drop out; a
null id stays. Repeated rows each give their row but count once for the fit, however
many there are. ``deviation`` is a decimal of 38 digits, which hold at 10 ** 11 vectors of
such spread as here; the query's is a long, as its contract says, and more than a long
holds (from some 10 ** 7 distinct vectors on) is an error, not a wrong number. Vectors of several lengths are an error, as are entries too large for
exact sums (above 2 ** 43 in size). An empty table gives no rows. Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlescope.llm.arrow import stored, table

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
MAX_DIMENSIONS = 2048
MAX_ENTRY = 2.0**43
_ROWS = 4096


def integer_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and x, the integer vector, of every row with a usable vector."""
    entries = F.col(f"`{column}`").cast("array<double>")
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    large = F.exists(entries, lambda c: F.abs(c) > MAX_ENTRY)
    whole = F.transform(entries, lambda c: F.floor(c * SCALE) + F.lit(SHIFT))
    return vectors.where(entries.isNotNull() & (F.size(entries) > 0) & ~bad).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.when(large, F.raise_error(F.lit(f"an entry is above {MAX_ENTRY:.0f}")).cast("array<bigint>"))
        .otherwise(whole)
        .alias("x"),
    )


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def pair_of(dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """The dimensions i <= j of each sum; where they are equal it is the dimension alone."""
    return np.triu_indices(dimensions)


def squares(d: np.ndarray) -> list[int]:
    """The exact sum over rows of the squares of each dimension and each sum of two."""
    out = []
    small = int(np.abs(d).max(initial=0)) < 1 << 24  # the squares of 4096 sums then fit 63 bits
    values = d if small else d.astype(object)
    for i in range(d.shape[1]):
        alone = (values[:, i] ** 2).sum()
        sums = ((values[:, i, None] + values[:, i + 1 :]) ** 2).sum(axis=0)
        out += [int(alone), *map(int, sums)]
    return out


@dataclass(frozen=True)
class Whitening:
    """A fitted model: rows, exact sums, eigenvalues, unit components (as columns), trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def centres(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """What n times the mean is above n times the centre, from 0 to n - 1."""
        return [s % self.n for s in self.sums]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """The centred vectors on each component over its standard deviation."""
        centred = (x - self.centres) - np.array([r / self.n for r in self.rest])
        return centred @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """The exact sum over dimensions of (n * x - S) ** 2 of each vector."""
        d = x - self.centres
        reach = self.n * (int(np.abs(d).max(initial=0)) + 1)
        if reach * reach * max(1, d.shape[1]) < 1 << 63:
            return ((self.n * d - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        return ((self.n * d.astype(object) - np.array(self.rest, object)) ** 2).sum(axis=1).tolist()


def covariance(n: int, sums: list[int], found: dict[int, int], centres: list[int]) -> np.ndarray:
    """Covariances from the squares around whole centres, exact up to one division each.

    n ** 2 times n times a variance is n * n * (squares) - n * (n * mean - n * centre) ** 2.
    """
    rows, columns = pair_of(len(sums))
    rest = [s - n * c for s, c in zip(sums, centres)]
    scaled: dict[tuple[int, int], int] = {}
    for k, (i, j) in enumerate(zip(rows.tolist(), columns.tolist())):
        off = rest[i] if i == j else rest[i] + rest[j]
        scaled[i, j] = n * found[k] - off * off
    out = np.zeros((len(sums), len(sums)))
    for (i, j), value in scaled.items():
        twice = 2 * value if i == j else value - scaled[i, i] - scaled[j, j]
        out[i, j] = out[j, i] = twice / (2 * n * n)
    return out


def fit(rows: DataFrame, components: int = COMPONENTS) -> tuple[Whitening | None, float]:
    """The model of the distinct vectors x, and the largest entry of their whitened
    covariance minus the identity; None without vectors."""
    listed = stored(rows.select("x").distinct(), "fit-list")
    sums = (
        listed.select(F.posexplode("x").alias("at", "value"))
        .groupBy("at")
        .agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("n"))
        .where(F.col("at") <= MAX_DIMENSIONS)
        .collect()
    )
    if not sums:
        return None, 0.0
    if len(sums) > MAX_DIMENSIONS or len({r.n for r in sums}) > 1:
        raise ValueError(f"vectors of several lengths, or of more than {MAX_DIMENSIONS} dimensions")
    n, totals = sums[0].n, [r.total for r in sorted(sums)]
    centres = [s // n for s in totals]
    found = _totals(listed, len(totals), np.array(centres, np.int64))
    matrix = covariance(n, totals, found, centres)
    trace = float(np.trace(matrix))
    values, vectors = np.linalg.eigh(matrix)
    chosen = [k for k in np.argsort(values)[::-1][:components] if values[k] > trace * len(totals) * 1e-15]
    axes = vectors[:, chosen]
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), range(len(chosen))])
    model = Whitening(n, totals, values[chosen], axes * signs, trace)
    return model, identity_error(listed, model)


def _totals(listed: DataFrame, dimensions: int, centres: np.ndarray) -> dict[int, int]:
    """The squares of each dimension and pair over all rows, by number."""
    arrow = pa.schema([("at", pa.int32()), ("total", pa.string())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] = []
        for batch in batches:
            for k in range(0, batch.num_rows, _ROWS):
                d = _matrix(batch.column("x").slice(k, _ROWS), dimensions) - centres
                found = squares(d)
                total = [a + b for a, b in zip(total, found)] if total else found
        if total:
            yield table(arrow, [list(range(len(total))), list(map(str, total))])

    parts = listed.mapInArrow(add, "at int, total string")
    exact = F.col("total").cast("decimal(38,0)")
    return {r.at: int(r.total) for r in parts.groupBy("at").agg(F.sum(exact).alias("total")).collect()}


def identity_error(listed: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity."""
    count = len(model.values)
    rows, columns = pair_of(count)
    arrow = pa.schema([("at", pa.int32()), ("total", pa.float64())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count + len(rows))
        for batch in batches:
            w = model.whiten(_matrix(batch.column("x"), len(model.sums)))
            total += np.concatenate([w.sum(axis=0), (w.T @ w)[rows, columns]])
        yield table(arrow, [np.arange(len(total), dtype=np.int32), total])

    parts = listed.mapInArrow(add, "at int, total double").groupBy("at").agg(F.sum("total").alias("total"))
    sums = np.zeros(count + len(rows))
    for row in parts.collect():
        sums[row.at] = row.total / model.n
    means = sums[:count]
    entries = sums[count:] - means[rows] * means[columns] - (rows == columns)
    return float(np.abs(entries).max(initial=0.0))


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, ``deviation`` (exact) and ``whitened``, one number per component, of every row."""
    dimensions = len(model.sums)
    arrow = pa.schema(
        [("vec_id", pa.int64()), ("deviation", pa.string()), ("whitened", pa.list_(pa.float64()))]
    )

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), dimensions)
            w = model.whiten(x)
            ends = np.arange(len(x) + 1, dtype=np.int32) * w.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(w.ravel()))
            exact = list(map(str, model.deviations(x)))
            yield table(arrow, [batch.column("vec_id"), exact, lists])

    done = rows.mapInArrow(project, "vec_id bigint, deviation string, whitened array<double>")
    return done.select("vec_id", F.col("deviation").cast("decimal(38,0)").alias("deviation"), "whitened")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    model, error = fit(rows)
    if model is None:
        nothing = F.array().cast("array<double>").alias("whitened")
        found, n, explained = rows.select("vec_id", F.lit(0).alias("deviation"), nothing), 0, []
    else:
        found, n, explained = whitened(rows, model), model.n, (model.values / model.trace).tolist()
    each = found.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = F.array(*[F.lit(e) for e in explained]).cast("array<double>")
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        F.col("deviation").cast("bigint").alias("deviation"),
        "whitened",
        F.get(share, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
