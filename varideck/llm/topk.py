"""Exact top-k search by inner product with multi-resolution segment statistics.

For segments of length L with means m and deviations s, |q - x|^2 >= sum L((mq - mx)^2 + (sq - sx)^2); with the norms that bounds the
inner product from above by sum L(mq mx + sq sx). Bounds go from one segment to many; a level drops the pairs that can't reach the
query's k-th best exact score so far, and survivors of the finest level are computed exactly.

Queries and candidates are packed into blocks. The blocks are dealt out to a grid of cells, some blocks of queries by some of candidates
in each, so that all pairs meet and no cell outgrows a task, however many vectors have the same length. A pair of blocks returns at most
k rows a query, which a window cuts to the k best. Components are whole numbers, so all sums are exact below 2**53; where norms allow
more, a pair of blocks is worked out in whole numbers of any size, without bounds.

Defined cases: vectors that are null, or hold null or non-finite components, take no part; vectors of different length are never
compared; an empty vector scores 0 with other empty ones; equal scores go to the smaller id; rows with the query's own id aren't its
candidates, repeated rows of other ids count one by one; rows with a null id take no part; fewer than k candidates give all of them;
a score beyond a long counts as the greatest or the least long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

LEVELS = (1, 4, 16)


def whole_vectors(df: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """id, v array<double>: floor(scale * x) of each component."""
    x = F.col(vector)
    fine = x.isNotNull() & F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e.cast("double")) != float("inf")), F.lit(False)))
    return df.filter(fine & F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("id"), F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double")).cast("double")).alias("v"))


def packed(vectors: DataFrame, rows: int) -> DataFrame:
    """dim int, n int, ids binary, data binary: blocks of at most `rows` vectors of equal length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, data = zip(*waiting.pop(dim), strict=True)
            blob = np.array(data, np.float64).reshape(len(ids), dim).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()]), pa.array([blob])], ["dim", "n", "ids", "data"])

        for batch in batches:
            at = np.asarray(batch.column(1).offsets)
            flat = np.asarray(batch.column(1).values)
            for i, a, b in zip(batch.column(0).to_pylist(), at[:-1], at[1:], strict=True):
                waiting.setdefault(int(b - a), []).append((i, flat[a:b].copy()))
                if len(waiting[int(b - a)]) >= rows:
                    yield block(int(b - a))
        for dim in list(waiting):
            yield block(dim)

    return vectors.mapInArrow(run, "dim int, n int, ids binary, data binary")


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose inner products are the upper bounds of a level: sqrt(L) m and sqrt(L) s of each segment."""
    parts = [p for p in np.array_split(np.arange(x.shape[1]), segments) if len(p)]
    columns = [np.sqrt(len(p)) * f for p in parts for f in (x[:, p].mean(1), x[:, p].std(1))]
    return np.stack(columns, 1) if columns else np.zeros((len(x), 0))


def best_of_blocks(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vector id, score) of the k best candidates of each query in a block, ties to smaller ids."""
    own = q_ids[:, None] == x_ids[None, :]
    if q.shape[1] and np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] >= 2.0**53:
        return best_of_large(q, q_ids, x, x_ids, k)
    levels = [s for s in LEVELS if s <= max(1, q.shape[1])]
    bound = segment_features(q, levels[0]) @ segment_features(x, levels[0]).T
    slack = 1e-9 * (np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1)[None, :] + 1)
    bound[own] = -np.inf
    n = min(k + 1, x.shape[0])  # one more, as the query itself may be among them
    probe = np.argpartition(-bound, n - 1, axis=1)[:, :n]
    probed = np.einsum("id,ikd->ik", q, x[probe])
    probed[np.take_along_axis(own, probe, 1)] = -np.inf
    least = -np.sort(-probed, axis=1)[:, min(k, n) - 1][:, None]  # k candidates reach it, so the k-th best does too
    live = (bound + slack >= least) & ~own
    for segments in levels[1:]:
        finer = segment_features(q, segments) @ segment_features(x, segments).T
        live &= finer + slack >= least
    if live.mean() > 0.05:
        score = np.where(live, q @ x.T, -np.inf)  # most pairs survive: one product costs less than gathering them
        if k < x.shape[0]:
            least = np.maximum(least, -np.partition(-score, k - 1, axis=1)[:, k - 1 : k])
        a, b = np.nonzero(live & (score >= least))
        s = score[a, b]
    else:
        a, b = np.nonzero(live)
        s = np.concatenate([np.einsum("id,id->i", q[a[i : i + 65536]], x[b[i : i + 65536]]) for i in range(0, len(a), 65536)] or [np.zeros(0)])
    order = np.lexsort((x_ids[b], -s, a))
    a, b, s = a[order], b[order], s[order]
    heads = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
    place = np.arange(len(a)) - np.repeat(heads, np.diff(np.r_[heads, len(a)]))
    keep = place < k
    return q_ids[a[keep]], x_ids[b[keep]], s[keep].astype(np.int64)


def best_of_large(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """best_of_blocks in whole numbers of any size."""
    whole, rows = np.vectorize(int, otypes=[object]), []
    columns, low, high = whole(x).T, -(1 << 63), (1 << 63) - 1
    for i, row in zip(q_ids.tolist(), whole(q), strict=True):
        scored = sorted((-min(max(s, low), high), j) for s, j in zip((row @ columns).tolist(), x_ids.tolist(), strict=True) if i != j)
        rows += [(i, j, -s) for s, j in scored[:k]]
    return tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else tuple(np.zeros(0, np.int64) for _ in range(3))


def top_k(df: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", scale: float = 64.0, query_rows: int = 512, candidate_rows: int = 4096, cell: int = 4) -> DataFrame:
    """query_id, rank, vec_id, score for every row that is_query (over a column `id`) marks, against all rows."""
    spark = df.sparkSession
    vectors = stored(whole_vectors(df, key, vector, scale), "vectors")
    n = vectors.count()
    n_queries = vectors.filter(is_query).count()
    blocks = packed(vectors.repartition(max(1, -(-n // candidate_rows))), candidate_rows)
    blocks = stored(blocks.withColumn("_at", F.monotonically_increasing_id()), "candidate-blocks")
    asked = packed(vectors.filter(is_query).repartition(max(1, -(-n_queries // query_rows))), query_rows)
    asked = stored(asked.withColumn("_at", F.monotonically_increasing_id()), "query-blocks")
    # Some `cell` blocks of a side meet as many of the other in a cell of the grid; a block goes to all cells of its row or column.
    rows, columns = (max(1, -(-blocks_ // (side * cell))) for blocks_, side in ((n_queries, query_rows), (n, candidate_rows)))
    place = lambda side: F.pmod(F.xxhash64("_at"), F.lit(side)).cast("int")
    every = lambda side: F.explode(F.sequence(F.lit(0), F.lit(side - 1)))
    asked = asked.select("dim", place(rows).alias("_row"), every(columns).alias("_column"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    blocks = blocks.select("dim", place(columns).alias("_column"), every(rows).alias("_row"), "ids", "data")
    # Blocks are a row of megabytes and many cells' copies of their file, whose size says little: neither side may go through the driver.
    pairs = asked.hint("merge").join(blocks, ["dim", "_row", "_column"]).select("dim", "q_ids", "q_data", "ids", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim, q_ids, q, ids, x = (c[i].as_py() for c in batch.columns)
                q_ids, ids = np.frombuffer(q_ids, np.int64), np.frombuffer(ids, np.int64)
                found = best_of_blocks(np.frombuffer(q).reshape(len(q_ids), dim), q_ids, np.frombuffer(x).reshape(len(ids), dim), ids, k)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["query_id", "vec_id", "score"])

    # A row holds two blocks, so few go into a batch; the setting holds for this job alone.
    setting, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(setting, "16")
    try:
        best = stored(pairs.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint"), "best-of-blocks")
    finally:
        spark.conf.set(setting, before)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
