"""Truncated SVD of the user x item rating matrix, kept as a long table of non-zero cells.

Up to `gram_limit` items the item Gramian is small by construction and its eigenvectors are exact.
Beyond that, block power iteration with a few more columns than asked for keeps every factor table
distributed; only matrices of that column count squared reach the driver. It goes on until the residual
|A v - s u| of every wanted triple is at most `tolerance` times the largest singular value; singular values
are then right to about the square of that, while a stop on their movement would also end a slow crawl.

Gramians are added up in levels of `FAN` partial matrices, so no task holds more of them, however many tasks
made them.

Cells of a repeated (user, item) pair add up in both; `latest_by` keeps the last rating instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.functions.ordering import with_position
from affinis.operators.dedup import dedup_keep_latest
from affinis.session import pin

GRAM_LIMIT = 2_048  # items; a Gramian of at most 32 MiB
OVERSAMPLE = 10
TOLERANCE = 1e-6
MAX_ITERATIONS = 1_000
FAN = 64  # partial matrices that one task adds up


@dataclass
class SvdModel:
    """user_factors (user_id, vector) = U S and item_factors (item_id, vector) = V."""

    user_factors: DataFrame
    item_factors: DataFrame
    singular_values: np.ndarray


def _cells(ratings: DataFrame) -> DataFrame:
    return ratings.filter(
        F.col("user_id").isNotNull() & F.col("item_id").isNotNull() & F.col("rating").isNotNull()
    ).select("user_id", "item_id", F.col("rating").cast("double").alias("rating"))


def _weighted_sums(cells: DataFrame, vectors: DataFrame, on: str, by: str, width: int) -> DataFrame:
    """Sum of rating * vector over the cells of each `by` id: one product with the matrix.

    Partial sums per `by` id form before the shuffle, whatever the number of cells of an id.
    """
    sums = [F.sum(F.col("rating") * F.col("vector")[j]).alias(f"c{j}") for j in range(width)]
    return (
        cells.join(vectors, on)
        .groupBy(by)
        .agg(*sums)
        .select(by, F.array(*[f"c{j}" for j in range(width)]).alias("vector"))
    )


def _levels(tasks: int) -> list[int]:
    """Into how many groups the partial matrices fall, level by level: FAN times fewer each time, down to one."""
    out = [1]
    while out[0] * FAN < tasks:
        out.insert(0, out[0] * FAN)
    return out


def _summed_matrix(parts: DataFrame, size: int, tasks: int | None = None) -> np.ndarray:
    """Add per-task matrices, given as (task, i, row), row by row; `size` is small and fixed."""

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size)
        for row in rows.sort_values("task")["row"]:
            total += row
        return pd.DataFrame({"task": np.array([key[1]], dtype="int32"), "i": np.array([key[0]], dtype="int32"), "row": [total]})

    for groups in _levels(tasks or int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))):
        parts = (
            parts.select(F.pmod("task", F.lit(groups)).alias("to"), "task", "i", "row")
            .groupBy("i", "to")
            .applyInPandas(add, _ROWS)
        )
    out = np.zeros((size, size))
    for record in parts.collect():  # one matrix
        out[record["i"]] = record["row"]
    return (out + out.T) / 2


_ROWS = "task INT, i INT, row ARRAY<DOUBLE>"


def _as_rows(matrix: np.ndarray) -> pd.DataFrame:
    task = np.full(len(matrix), TaskContext.get().partitionId(), dtype="int32")
    return pd.DataFrame({"task": task, "i": np.arange(len(matrix), dtype="int32"), "row": list(matrix)})


def _sparse_gramian(cells: DataFrame, items: DataFrame, size: int) -> np.ndarray:
    """Item Gramian from sparse user rows, each of at most `size` cells, added up per task."""
    rows = (
        cells.join(F.broadcast(items), "item_id")  # at most GRAM_LIMIT rows
        .groupBy("user_id")
        .agg(F.collect_list("idx").alias("idx"), F.collect_list("rating").alias("rating"))
        .select("idx", "rating")
    )

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size))
        for batch in batches:
            for start in range(0, len(batch), 1_024):
                part = batch.iloc[start : start + 1_024]
                dense = np.zeros((len(part), size))
                lengths = [len(v) for v in part["idx"]]
                at = np.repeat(np.arange(len(part)), lengths)
                np.add.at(
                    dense,
                    (at, np.concatenate(part["idx"].to_numpy())),
                    np.concatenate(part["rating"].to_numpy()),
                )
                total += dense.T @ dense
        yield _as_rows(total)

    return _summed_matrix(rows.mapInPandas(partial, _ROWS), size)


def _dense_gramian(vectors: DataFrame, size: int) -> np.ndarray:
    """Column Gramian of a table of `size`-long vectors."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size))
        for batch in batches:
            if len(batch):
                block = np.stack(batch["vector"].to_numpy())
                total += block.T @ block
        yield _as_rows(total)

    parts = vectors.select("vector").mapInPandas(partial, _ROWS)
    return _summed_matrix(parts, size)


def _times(vectors: DataFrame, key: str, matrix: np.ndarray) -> DataFrame:
    """Every vector times a small matrix that travels with the task."""

    def product(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                block = np.stack(batch["vector"].to_numpy()) @ matrix
                yield pd.DataFrame({key: batch[key].to_numpy(), "vector": list(block)})

    return vectors.select(key, "vector").mapInPandas(product, f"{key} BIGINT, vector ARRAY<DOUBLE>")


def _descending(gramian: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, vectors = np.linalg.eigh(gramian)
    return np.clip(values[::-1], 0.0, None), vectors[:, ::-1]


def truncated_svd(
    ratings: DataFrame,
    n_components: int = 50,
    gram_limit: int = GRAM_LIMIT,
    tolerance: float = TOLERANCE,
    seed: int = 42,
    latest_by: str | None = None,
) -> SvdModel:
    """Rank-k factors of the zero-filled rating matrix.

    The table is read several times: give a written one. `latest_by` names a time column by which the last
    rating of a pair is kept first; without it repeated pairs add up. No cells give empty factors.
    """
    if latest_by:
        ratings = pin(dedup_keep_latest(ratings, time=latest_by, tiebreak=["rating"]))
    cells = _cells(ratings)
    items = cells.select("item_id").distinct()
    n_items = items.count()
    if n_items == 0:
        empty = cells.sparkSession.createDataFrame
        return SvdModel(
            empty([], "user_id BIGINT, vector ARRAY<DOUBLE>"), empty([], "item_id BIGINT, vector ARRAY<DOUBLE>"), np.zeros(0)
        )
    if n_items <= gram_limit:
        return _exact(cells, items, n_items, n_components)
    return _iterated(cells, items, min(n_items, n_components + OVERSAMPLE), n_components, tolerance, seed)


def _exact(cells: DataFrame, items: DataFrame, n_items: int, k: int) -> SvdModel:
    spark = cells.sparkSession
    indexed = pin(with_position(items, ["item_id"], "at").select("item_id", F.col("at").cast("int").alias("idx")))
    k = min(k, n_items)
    values, basis = _descending(_sparse_gramian(cells, indexed, n_items))
    ids = [r["item_id"] for r in indexed.orderBy("idx").collect()]  # at most gram_limit ids
    factors = [(int(i), [float(x) for x in row]) for i, row in zip(ids, basis[:, :k])]
    item_factors = spark.createDataFrame(factors, "item_id BIGINT, vector ARRAY<DOUBLE>")
    user_factors = pin(_weighted_sums(cells, item_factors, "item_id", "user_id", k))
    return SvdModel(user_factors, item_factors, np.sqrt(values[:k]))


def _iterated(
    cells: DataFrame, items: DataFrame, width: int, k: int, tolerance: float, seed: int
) -> SvdModel:
    # Start vectors depend on the item alone, so a repeated task draws the same ones.
    draws = [
        (F.pmod(F.xxhash64("item_id", F.lit(seed + j)), F.lit(1 << 20)) / (1 << 19)) - 1.0
        for j in range(width)
    ]
    of_items = items.select("item_id", F.array(*draws).alias("vector"))
    wanted, sigma, left = min(k, width), None, np.inf
    for _ in range(MAX_ITERATIONS):
        of_users = pin(_weighted_sums(cells, of_items, "item_id", "user_id", width))
        gramian = _dense_gramian(of_users, width)
        if sigma is not None:
            # The items' columns are orthonormal and s v = A^T u, so |A v - s u|^2 = |A v|^2 - s^2.
            left = np.sqrt(np.maximum(np.diag(gramian) - sigma**2, 0.0))[:wanted].max()
            if left <= tolerance * sigma[0]:
                break
        values, basis = _descending(gramian)
        weight = np.where(values > values[0] * 1e-13, values, np.inf)
        of_users = pin(_times(of_users, "user_id", basis / np.sqrt(weight)))
        of_items = pin(_weighted_sums(cells, of_users, "user_id", "item_id", width))
        values, basis = _descending(_dense_gramian(of_items, width))
        sigma = np.sqrt(values)
        weight = np.where(values > values[0] * 1e-13, values, np.inf)
        of_items = pin(_times(of_items, "item_id", basis / np.sqrt(weight)))
    else:
        raise RuntimeError(f"a residual of {left / sigma[0]:.1e} of the largest singular value is left after {MAX_ITERATIONS} iterations")
    # The best triples within the last block: A V turned by the eigenvectors of its Gramian is U S.
    values, turn = _descending(gramian)
    item_factors = pin(_times(of_items, "item_id", turn[:, :wanted]))
    user_factors = pin(_times(of_users, "user_id", turn[:, :wanted]))
    return SvdModel(user_factors, item_factors, np.sqrt(values[:wanted]))


def explained_variance(ratings: DataFrame, model: SvdModel) -> DataFrame:
    """One row: variance of the user factors over the variance of the matrix columns."""
    cells = _cells(ratings)
    users = cells.agg(F.count_distinct("user_id")).scalar().cast("double")
    width = len(model.singular_values)
    if not width:
        return cells.agg(F.lit(None).cast("double").alias("explained_variance"))
    spread = model.user_factors.agg(
        *[F.var_pop(F.col("vector")[j]).alias(f"v{j}") for j in range(width)]
    ).select(sum((F.col(f"v{j}") for j in range(1, width)), F.col("v0")).alias("v"))
    columns = (
        cells.groupBy("item_id")
        .agg(F.sum("rating").alias("s"), F.sum(F.col("rating") * F.col("rating")).alias("q"))
        .select((F.col("q") / users - (F.col("s") / users) * (F.col("s") / users)).alias("v"))
    )
    total = columns.agg(F.sum("v").alias("total"))
    return total.select((spread.scalar() / F.col("total")).alias("explained_variance"))
