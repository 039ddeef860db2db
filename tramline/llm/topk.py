"""Exact top-k search by columnar branch and bound.

Vectors lie dimension by dimension. Scores are accumulated one block of dimensions at a time;
after each block, what the rest can still add or take away is bounded by the product of the
remaining lengths, and candidates whose upper bound lies under the k-th best lower bound are
compacted away. Queries meet candidates in cells of bounded size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.common import landed, ship_package

QUERIES_PER_CELL = 1024
CANDIDATES_PER_CELL = 16_384
DIMENSIONS_AT_ONCE = 8
SCALE = 256
_FOUND = "query long, query_id long, vec_id long, nameless boolean, score long"
# Stands for a null vec_id in ties.
_LAST = (1 << 63) - 1


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """`vec_id, components` with components floor(scale * x); null vectors and those with null or non-finite
    components are left out. A null vec_id stays."""
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
        .filter(F.col("e").isNotNull() & F.forall("e", sound))
        .select("vec_id", F.transform("e", lambda x: F.floor(x * scale)).alias("components"))
    )


def search(vectors: DataFrame, asked: Column, k: int = 5) -> DataFrame:
    """`query_id, rank, vec_id, score`: the `k` largest integer inner products of each row for which `asked` holds.

    `vectors` holds `vec_id, components`. Every row but the query's own is its candidate, also rows that repeat
    its vec_id; rows that repeat a query's id are queries of their own. Ties go to the smaller vec_id, null last. Shorter
    vectors count as padded with zeros. Scores must fit a long.
    """
    ship_package(vectors.sparkSession)
    rows = landed(
        vectors.select(
            F.monotonically_increasing_id().alias("row"),
            F.coalesce("vec_id", F.lit(_LAST)).alias("vec_id"),
            F.col("vec_id").isNull().alias("nameless"),
            F.coalesce(asked, F.lit(False)).alias("asked"),
            "components",
        ),
        "vectors",
    )
    queries = rows.filter("asked")
    query_blocks = max(1, -(-queries.count() // QUERIES_PER_CELL))
    held_blocks = max(1, -(-rows.count() // CANDIDATES_PER_CELL))
    columns = ["row", "vec_id", "nameless", "components"]

    def block(count: int, name: str) -> Column:
        # By row, so that a vec_id of many rows is dealt like any others.
        return F.pmod(F.xxhash64("row"), F.lit(count)).cast("int").alias(name)

    def every(count: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)

    cells = queries.select(
        block(query_blocks, "asking"), every(held_blocks, "holding"), F.lit(True).alias("is_query"), *columns
    ).unionByName(
        rows.select(every(query_blocks, "asking"), block(held_blocks, "holding"), F.lit(False).alias("is_query"), *columns)
    )

    def best(cell: pd.DataFrame) -> pd.DataFrame:
        is_query = cell["is_query"].to_numpy()
        width = max((len(c) for c in cell["components"]), default=0)
        vertical = np.zeros((width, len(cell)), np.int64)
        for at, components in enumerate(cell["components"]):
            vertical[: len(components), at] = components
        numbers, ids, nameless = (cell[name].to_numpy() for name in ("row", "vec_id", "nameless"))
        held = ~is_query
        found = _cell(vertical[:, is_query], numbers[is_query], vertical[:, held], numbers[held], ids[held], k)
        query_id = dict(zip(numbers[is_query].tolist(), ids[is_query].tolist()))
        return pd.DataFrame({
            "query": [n for n, _, _ in found], "query_id": [query_id[n] for n, _, _ in found],
            "vec_id": [ids[held][at] for _, at, _ in found], "nameless": [nameless[held][at] for _, at, _ in found],
            "score": [score for _, _, score in found],
        }).astype({"query": "int64", "query_id": "int64", "vec_id": "int64", "nameless": "bool", "score": "int64"})

    found = cells.groupBy("asking", "holding").applyInPandas(best, _FOUND)
    first = Window.partitionBy("query").orderBy(F.desc("score"), "nameless", "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.when(~F.col("nameless"), F.col("vec_id")).alias("vec_id"), "score"
    )


def _cell(
    asked: np.ndarray, query_rows: np.ndarray, held: np.ndarray, held_rows: np.ndarray, held_ids: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """(row of the query, place among the held ones, score) of each query's best."""
    order = np.argsort(-np.abs(held).sum(axis=1, dtype=np.float64)) if held.size else np.arange(len(held))
    asked, held = asked[order], held[order]
    largest = lambda m: float(np.abs(m).max(initial=0))
    # Doubles hold every partial score exactly below 2^53; longs are used beyond that.
    if largest(asked) * largest(held) * max(1, len(held)) < 2**53:
        asked, held = asked.astype(np.float64), held.astype(np.float64)
    starts = list(range(0, len(held), DIMENSIONS_AT_ONCE))
    rests = {s: _rest_lengths(held[s + DIMENSIONS_AT_ONCE :]) for s in starts}
    out = []
    for at, query_row in enumerate(query_rows.tolist()):
        query = asked[:, at]
        alive = np.flatnonzero(held_rows != query_row)
        scores = np.zeros(len(alive), held.dtype)
        for s in starts:
            e = s + DIMENSIONS_AT_ONCE
            scores = scores + query[s:e] @ held[s:e, alive]
            if e < len(held) and len(alive) > k:
                # A little more than the exact bound, for the rounding of the lengths.
                slack = np.sqrt(np.square(query[e:].astype(np.float64)).sum()) * rests[s][alive] * (1 + 1e-9) + 1
                slack += np.abs(scores) * 1e-12
                least = np.partition(scores - slack, len(alive) - k)[len(alive) - k]
                stay = scores + slack >= least
                alive, scores = alive[stay], scores[stay]
        top = np.lexsort((held_ids[alive], -scores))[:k]
        out += [(query_row, int(alive[n]), int(scores[n])) for n in top]
    return out


def _rest_lengths(rest: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(rest.astype(np.float64)).sum(axis=0))
