"""Whitening of embeddings by shifted CholeskyQR: Gram passes over the centred rows, triangular solves, one SVD of the composed factor."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
PASSES = 3
# Larger entries have no whole number that sums could hold exactly.
LARGEST = 2.0**40
# Rows of a Gram matrix that meet in one task before the next round adds them up.
FAN_IN = 64
LONGS = 2**62


def whole_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``rows`` with ``x``, floor(64 c) + 1,000,000 of each entry; rows without a whole vector of the common length are left out."""
    entries = F.transform(F.col(vector), lambda c: F.try_add(F.floor(c.cast("double") * SCALE), F.lit(OFFSET)))
    sound = F.forall(F.col(vector), lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) <= LARGEST), F.lit(False)))
    kept = rows.where(F.coalesce(sound, F.lit(False)) & (F.size(vector) > 0)).withColumn("x", entries)
    lengths = kept.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return kept.where(F.size("x") == (lengths.d if lengths else -1))


def stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.int64)


def centred(x: np.ndarray, sums: list[int], n: int) -> np.ndarray:
    """x - S / n: the whole number n x - S is made first, so that nothing is lost to the offset."""
    return scaled(x, sums, n).astype(np.float64) / n


def scaled(x: np.ndarray, sums: list[int], n: int) -> np.ndarray:
    """n x - S in whole numbers; Python's own where 64 bits are too few."""
    if n * max(int(np.abs(x).max(initial=0)), 1) < LONGS and max(map(abs, sums), default=0) < LONGS:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """rows R1^-1 R2^-1 ...: for each upper triangular factor, columns from left to right."""
    for r in factors:
        out = np.empty_like(rows)
        for j in range(r.shape[1]):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


GRAM = T.StructType(
    [T.StructField("part", T.LongType()), T.StructField("n", T.LongType()), T.StructField("gram", T.BinaryType()), T.StructField("sums", T.BinaryType())]
)


def added(parts: DataFrame) -> DataFrame:
    """One row per ``part``: the sums of its matrices."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for batch in batches:
            for part, n, gram, sums in batch.itertuples(index=False):
                gram, sums = np.frombuffer(gram), np.frombuffer(sums)
                if part in held:
                    held[part][0] += n
                    held[part][1] += gram
                    held[part][2] += sums
                else:
                    held[part] = [n, gram.copy(), sums.copy()]
        yield pd.DataFrame([(p, n, g.tobytes(), s.tobytes()) for p, (n, g, s) in held.items()], columns=["part", "n", "gram", "sums"])

    return parts.mapInPandas(add, GRAM)


def gram_of(rows: DataFrame, transform, name: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, Gram matrix and column sums of ``transform(x)`` over all rows.

    Every task adds up its own rows; the tasks' matrices meet in a tree, ``FAN_IN`` in a task, until one is left.
    """

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, gram, sums = 0, None, None
        for batch in batches:
            if len(batch):
                q = transform(stacked(batch["x"]))
                n += len(q)
                gram = q.T @ q if gram is None else gram + q.T @ q
                sums = q.sum(axis=0) if sums is None else sums + q.sum(axis=0)
        if n:
            yield pd.DataFrame({"part": [0], "n": [n], "gram": [gram.tobytes()], "sums": [sums.tobytes()]})

    parts = rows.select("x").mapInPandas(own, GRAM).withColumn("part", F.spark_partition_id().cast("long"))
    parts = materialise(parts, name)
    left = parts.count()
    while left > 1:
        tasks = -(-left // FAN_IN)
        dealt = parts.withColumn("part", F.col("part") % tasks).repartition(tasks, "part")
        parts = materialise(added(dealt), name)
        left = parts.select("part").distinct().count() if tasks > 1 else 1
    found = parts.first()
    d = len(found.sums) // 8
    return found.n, np.frombuffer(found.gram).reshape(d, d), np.frombuffer(found.sums)


def triangular_factor(rows: DataFrame, sums: list[int], n: int, passes: int = PASSES) -> np.ndarray:
    """R of the centred rows A = Q R, d by d, by shifted CholeskyQR.

    The Gram matrix of the first pass is shifted before it is factorised, so that rounding can't make it
    indefinite however badly conditioned A is; its rows, solved by that factor, are close enough to orthogonal
    for the next passes, which need next to no shift. R is the product of all factors. Q is never stored: each pass
    solves the rows again. Columns that depend on others stay dependent in R.
    """
    d, factors, whole = len(sums), [], np.eye(len(sums))
    for number in range(passes):
        solvers = list(factors)
        _, gram, _ = gram_of(rows, lambda x: solved(centred(x, sums, n), solvers), f"gram-{number}")
        gram = (gram + gram.T) / 2
        size = max(float(np.linalg.norm(gram, 2)), np.finfo(float).tiny)
        unit = np.finfo(float).eps / 2
        shift = (11 * (n * d + d * (d + 1)) * unit if not number else 4 * d * unit) * size
        while True:
            try:
                factor = np.linalg.cholesky(gram + shift * np.eye(d)).T
                break
            except np.linalg.LinAlgError:
                shift *= 10
        factors.append(factor)
        whole = factor @ whole
    return whole


class Whitening:
    """Means, components and eigenvalues, as fitted: ``sums`` / ``n``, one column a component, falling."""

    def __init__(self, n: int, sums: list[int], factor: np.ndarray, components: int):
        self.n, self.sums = n, sums
        _, singular, right = np.linalg.svd(factor)
        variance = singular**2 / n
        # Directions in which the fit list doesn't vary have no whitened value.
        rank = int((variance > variance[0] * len(sums) * 1e-12).sum()) if len(variance) and variance[0] > 1e-18 else 0
        self.total = float(variance.sum())
        self.variance = variance[: min(components, rank)]
        self.axes = right[: len(self.variance)].T

    def white(self, x: np.ndarray) -> np.ndarray:
        return (centred(x, self.sums, self.n) @ self.axes) / np.sqrt(self.variance)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The exact sum of (n x - S)^2 of each row; None if it needs more than 64 bits."""
        far = scaled(x, self.sums, self.n)
        if far.dtype != object and len(self.sums) * max(int(np.abs(far).max(initial=0)), 1) ** 2 < LONGS:
            return (far * far).sum(axis=1).tolist()
        return [v if (v := sum(int(e) ** 2 for e in row)) < 2**63 else None for row in far]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Whitening | None, DataFrame]:
    """The whitening of the distinct ``x`` of ``vectors``, and the written table of these."""
    once = materialise(vectors.select("x").distinct(), "fit-list")
    first = once.first()
    if first is None:
        return None, once
    sums = once.agg(F.count("*"), *[F.sum(F.get("x", F.lit(j)).cast("decimal(20,0)")) for j in range(len(first.x))]).first()
    n, sums = sums[0], [int(s) for s in sums[1:]]
    return Whitening(n, sums, triangular_factor(once, sums, n), components), once


def identity_error(model: Whitening, once: DataFrame) -> float:
    """The largest absolute entry of the covariance of the whitened fit list minus the identity; it is centred by its own mean first."""
    k = len(model.variance)
    _, _, sums = gram_of(once, model.white, "white-mean")
    mean = sums / model.n
    _, gram, _ = gram_of(once, lambda x: model.white(x) - mean, "white-gram")
    return float(np.abs(gram / model.n - np.eye(k)).max(initial=0.0))


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error of every sound row and component.

    Entries become whole numbers x; the components are those of the distinct x vectors' covariance, by falling
    eigenvalue (:func:`triangular_factor`, :class:`Whitening`). ``whitened`` is the row's projection over the root
    of the eigenvalue, ``explained`` the eigenvalue's share of all variance.

    Rows with a null vector, a null, NaN or infinite entry, an entry beyond 2^40 or no entries are left out, and
    so are rows with another number of entries than most have (of several numbers as frequent, the largest).
    Copies of a vector count once in the fit; repeated rows, and null ids, each have their own result. Components
    without variance (fewer distinct vectors than dimensions, constant entries) are left out; if no component
    is left, or the table is empty, there are no rows. A deviation beyond 64 bits is null. Other columns are
    not read, whatever their names.
    """
    vectors = whole_vectors(rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector")), "vector").select("vec_id", "x")
    model, once = fit(vectors, components)
    id_type = vectors.schema["vec_id"].dataType
    fields = "whitened array<double>, deviation long"
    names = ("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
    if model is None or not len(model.variance):
        types = (id_type.simpleString(), "int", "long", "long", "double", "double", "double")
        return rows.sparkSession.createDataFrame([], ", ".join(f"{n} {t}" for n, t in zip(names, types)))
    error = identity_error(model, once)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def place(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = stacked(batch) if len(batch) else np.empty((0, len(shared.value.sums)), np.int64)
            white = shared.value.white(x) if len(batch) else x
            yield pd.DataFrame({"whitened": list(white), "deviation": pd.array(shared.value.deviation(x), "Int64")})

    placed = vectors.select("vec_id", F.pandas_udf(place, fields)("x").alias("at"))
    explained = F.array(*[F.lit(float(v / model.total)) for v in model.variance])
    out = placed.select("vec_id", F.col("at.deviation").alias("deviation"), F.posexplode("at.whitened").alias("place", "whitened"))
    return out.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
