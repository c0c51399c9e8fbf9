"""Exact top-k by inner product over integer vectors, with norm buckets.

Components become floor(scale * x). Rows are dealt into cells by their length on a geometric grid,
and a large cell into blocks of at most about ``BLOCK`` rows, so a length shared by many rows is no
hot group; queries are dealt into blocks likewise. Two steps:

* A first bound: every query meets the ``SEEDS`` longest rows, and its k-th best product there is a
  lower bound of its k-th best overall.
* Each query block meets the row blocks that can still matter: product <= |query| * longest row, so
  a cell is skipped by a query whose bound is above that. A pair of blocks is one group. In it, rows
  are cut into buckets of similar length, and a bucket gives each query a local cosine threshold,
  bound / (|query| * longest row of the bucket). Above one, the bucket is skipped; if the threshold
  is low, the bucket is pruned by length (a prefix of rows in falling length); if it is high, by
  coordinates (the rows whose largest query coordinates lie in the interval the threshold leaves).
  Products are computed for what is left, and bounds rise from bucket to bucket.

Each pair of blocks returns k rows a query, and the best k of these are the result.

Products are exact whatever the size of the components: scaled and floored components are whole numbers as
doubles, products are summed in doubles below 2**53, in 64-bit integers below 2**63, and for the vectors
beyond that in Python's integers.

Defined results: a vector that is null, holds null or a non-finite number, or a number that is no longer
finite when scaled, takes no part, neither does a row without an id. A score beyond BIGINT ranks as what it
is and is returned as null. Vectors of different lengths are
compared as if the shorter one went on with zeros. Rows that repeat an id are rows of their own,
but a query never meets a row with its own id, and a repeated query id is asked once (with its
greatest vector). Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchlake.llm.arrow import ship, with_columns
from batchlake.session import materialize

#: Rows of a block, queries of a block, rows of a bucket, rows of the first bound.
BLOCK, QUERIES, BUCKET, SEEDS = 8_192, 2_048, 512, 1_024
#: Ratio of lengths between neighbouring cells of the grid.
RATIO = 1.25
#: Local cosine threshold from which on coordinates prune better than lengths.
HIGH = 0.6
#: Coordinates that coordinate pruning looks at.
FOCUS = 3


def integer_vectors(vectors: DataFrame, scale: int, vec_id: str, column: str) -> DataFrame:
    """``id``, ``v`` (whole numbers as DOUBLE) and ``norm`` of the rows that take part."""

    def whole(x: Column) -> Column:
        scaled = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)

    fine = F.forall(
        F.col(column), lambda x: x.isNotNull() & (F.abs(F.lit(float(scale)) * x.cast("double")) < float("inf"))
    )
    rows = with_columns(vectors, vec_id, column).where(
        F.col(vec_id).isNotNull() & F.col(column).isNotNull() & fine
    )
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    return rows.select(
        F.col(vec_id).cast("bigint").alias("id"), F.transform(F.col(column), whole).alias("v")
    ).withColumn("norm", F.sqrt(squares))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """List column to a matrix of ``width`` columns, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width))
    if len(flat):
        row = np.repeat(np.arange(len(sizes)), sizes)
        out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _width(*columns: pa.Array) -> int:
    return max([1, *(int(pa.compute.max(pa.compute.list_value_length(c)).as_py() or 0) for c in columns)])


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer products, exact where every sum stays below 2**63."""
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), dtype=np.int64)
    if float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1] < 2.0**53:
        return np.rint(q @ c.T).astype(np.int64)
    return q.astype(np.int64) @ c.astype(np.int64).T


def _wide(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Products in Python's integers."""
    whole = [np.array([int(x) for x in m.ravel().tolist()], dtype=object).reshape(m.shape) for m in (q, c)]
    return whole[0] @ whole[1].T


class _Best:
    """The best k (score, id) of each of a number of queries."""

    def __init__(self, k: int, bound: np.ndarray):
        self.k, self.bound = k, bound.astype(float)
        self.kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, query: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        keep = score >= self.bound[query]
        self.kept.append((query[keep], score[keep], row[keep]))
        self.size += int(keep.sum())
        if self.size > 4 * self.k * len(self.bound) + 65_536:
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cut down to k per query, ties to the smaller id, and raise the bounds."""
        if not self.kept:
            return (np.zeros(0, np.int64),) * 3
        query, score, row = (np.concatenate(x) for x in zip(*self.kept, strict=True))
        order = np.lexsort((row, -score, query))
        query, score, row = query[order], score[order], row[order]
        first = np.searchsorted(query, np.arange(len(self.bound)))
        rank = np.arange(len(query)) - first[query]
        last = rank == self.k - 1
        self.bound[query[last]] = np.maximum(self.bound[query[last]], score[last])
        top = rank < self.k
        self.kept = [(query[top], score[top], row[top])]
        self.size = int(top.sum())
        return self.kept[0]


def _coordinate_rows(unit: np.ndarray, query: np.ndarray, least: float) -> np.ndarray:
    """Rows of unit vectors that can have a cosine of ``least`` or more with the unit ``query``.

    On a coordinate f, cos <= q*c + sqrt(1-q*q) * sqrt(1-c*c), which holds c to an interval.
    """
    alive = np.ones(len(unit), dtype=bool)
    for f in np.argsort(-np.abs(query))[:FOCUS]:
        q = query[f]
        half = np.sqrt(max(0.0, 1 - q * q)) * np.sqrt(max(0.0, 1 - least * least))
        low = q * least - half if q > -least else -1.0
        high = q * least + half if q < least else 1.0
        alive &= (unit[:, f] >= low - 1e-9) & (unit[:, f] <= high + 1e-9)
    return np.flatnonzero(alive)


def search_block(queries: pa.Table, rows: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, score, row id) of the best k rows of each query; its own id is left out. Scores are
    Python's integers if any may be beyond 64 bits."""
    width = _width(queries["v"], rows["v"])
    q, c = _matrix(queries["v"], width), _matrix(rows["v"], width)
    qid, cid = queries["id"].to_numpy(), rows["id"].to_numpy()
    qn, cn = queries["norm"].to_numpy(), rows["norm"].to_numpy()
    bound = queries["bound"].to_numpy()
    # Products of vectors within this limit fit 64 bits. The few others are multiplied on their own.
    limit = np.sqrt(2.0**62 / width)
    large_q, large_c = (np.abs(m).max(axis=1, initial=0) > limit for m in (q, c))
    if not (large_q.any() or large_c.any()):
        return _search(q, qid, qn, bound, c, cid, cn, k)
    small_q, small_c = np.flatnonzero(~large_q), np.flatnonzero(~large_c)
    at, score, row = _search(q[small_q], qid[small_q], qn[small_q], bound[small_q], c[small_c], cid[small_c], cn[small_c], k)
    found: dict[int, list[tuple[int, int]]] = {i: [] for i in range(len(q))}
    for i, s, r in zip(small_q[at].tolist(), score.tolist(), row.tolist(), strict=True):
        found[i].append((-s, r))
    for mine, theirs in ((np.arange(len(q)), np.flatnonzero(large_c)), (np.flatnonzero(large_q), small_c)):
        for i in mine.tolist():
            scores = _wide(q[i : i + 1], c[theirs])[0] if len(theirs) else []
            best = sorted((-s, r) for s, r in zip(scores, cid[theirs].tolist(), strict=True) if r != qid[i])
            found[i] = sorted(found[i] + best[:k])[:k]
    flat = [(i, -s, r) for i, best in found.items() for s, r in best[:k]]
    scores = np.empty(len(flat), dtype=object)
    scores[:] = [s for _, s, _ in flat]
    return np.array([i for i, _, _ in flat], np.int64), scores, np.array([r for _, _, r in flat], np.int64)


def _search(q, qid, qn, bound, c, cid, cn, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The search among vectors whose products fit 64 bits."""
    best = _Best(k, bound)
    order = np.lexsort((cid, -cn))
    c, cid, cn = c[order], cid[order], cn[order]
    for begin in range(0, len(c), BUCKET):
        end = min(len(c), begin + BUCKET)
        longest, lengths = cn[begin], cn[begin:end]
        reach = qn * longest
        # A hair is taken off each bound, so that rounding never prunes a tie.
        floor = best.bound - 1e-9 * np.abs(best.bound) - 1e-6
        alive = np.flatnonzero(reach >= floor)
        if not len(alive):
            if longest == 0:
                break
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(reach[alive] > 0, floor[alive] / reach[alive], -np.inf)
        pruned = local >= HIGH
        by_length = alive[~pruned]
        if len(by_length):
            score = _products(q[by_length], c[begin:end])
            fit = (qn[by_length, None] * lengths[None] >= floor[by_length, None]) & (
                qid[by_length, None] != cid[None, begin:end]
            )
            at, row = np.nonzero(fit)
            best.add(by_length[at], score[at, row], cid[begin + row])
        if pruned.any():
            unit = c[begin:end] / np.maximum(lengths, 1e-300)[:, None]
            for i, least in zip(alive[pruned], local[pruned], strict=True):
                left = _coordinate_rows(unit, q[i] / qn[i], min(1.0, float(least)))
                left = left[cid[begin + left] != qid[i]]
                if len(left):
                    score = _products(q[i : i + 1], c[begin + left])[0]
                    best.add(np.full(len(left), i), score, cid[begin + left])
        best.settle()
    return best.settle()


def _floats(score: np.ndarray) -> np.ndarray:
    """Scores as doubles, within their range."""
    if score.dtype != object:
        return score.astype(float)
    most = int(1e308)
    return np.array([float(max(-most, min(most, s))) for s in score.tolist()])


def _digits(score: int) -> str:
    """A score beyond 64 bits as text that sorts like it among those of its sign."""
    text = str(abs(score))
    placed = f"{len(text):04d}{text}"
    return placed if score >= 0 else "".join(chr(ord("0") + 9 - int(d)) for d in placed) + "~"


def top_k(
    vectors: DataFrame,
    k: int = 10,
    scale: int = 1024,
    every: int = 100,
    vec_id: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the best ``k`` rows of each query. The
    queries are the rows whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    ship(spark)
    rows = materialize(
        integer_vectors(vectors, scale, vec_id, column).withColumn(
            "cell", F.floor(F.log1p(F.least("norm", F.lit(1e300))) / F.log(F.lit(RATIO))).cast("int")
        ),
        "vectors",
    )
    # Lengths lie between 0 and 1e300, so the grid has some 3 100 cells at most.
    cells = (
        rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest")).collect()
    )
    grid = [(r["cell"], -(-r["n"] // BLOCK), r["longest"]) for r in cells]

    # The seeds: a fixed number of the longest rows, sent to every task.
    seeds = (
        rows.select("id", "v", "norm").orderBy(F.desc("norm"), "id").limit(SEEDS).toArrow()
    )
    asked = (
        rows.where(F.col("id") % every == 0)
        .groupBy("id")
        .agg(F.max(F.struct("v", "norm")).alias("q"))
        .select("id", "q.v", "q.norm")
    )

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = part.append_column("bound", pa.array(np.full(len(part), -np.inf)))
            query, score, _ = search_block(part, seeds, k)
            bound = np.full(len(part), -np.inf)
            full = np.bincount(query, minlength=len(part)) >= k
            least = np.full(len(part), np.inf)
            np.minimum.at(least, query, _floats(score))
            bound[full] = least[full]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bound)], ["id", "v", "norm", "bound"])

    schema = "id bigint, v array<double>, norm double, bound double"
    queries = materialize(asked.mapInArrow(bounded, schema), "queries")
    n_queries = queries.count()
    groups = max(1, -(-n_queries // QUERIES))

    slack = F.abs("bound") * 1e-9 + 1e-6
    known = F.array(
        *[F.struct(F.lit(c).alias("cell"), F.lit(b).alias("blocks"), F.lit(x).alias("longest")) for c, b, x in grid]
    )
    if not grid:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    # A query goes to the blocks of those cells that its bound leaves.
    left = (
        queries.withColumn("cells", F.filter(known, lambda c: F.col("norm") * c["longest"] >= F.col("bound") - slack))
        .select("*", F.inline("cells"))
        .select(
            "id", "v", "norm", "bound", "cell",
            F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("part"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        )
    )
    # A row goes to the query parts that want its block, if their longest query can reach their lowest bound with it.
    wanted = (
        left.groupBy("cell", "block", "part")
        .agg(F.max("norm").alias("far"), F.min("bound").alias("low"))
        .groupBy("cell", "block")
        .agg(F.collect_list(F.struct("part", "far", "low")).alias("parts"))
    )
    blocks = F.create_map(*[F.lit(x) for c, b, _ in grid for x in (c, b)])
    near = F.filter(
        "parts", lambda p: F.col("norm") * p["far"] >= p["low"] - F.abs(p["low"]) * 1e-9 - 1e-6
    )
    right = (
        rows.withColumn("block", F.pmod(F.xxhash64("id", "v"), blocks[F.col("cell")]).cast("int"))
        .join(wanted, ["cell", "block"])
        .select("id", "v", "norm", "cell", "block", F.explode(F.transform(near, lambda p: p["part"])).alias("part"))
    )

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not len(queries) or not len(rows):
            found = (np.zeros(0, np.int64),) * 3
        else:
            found = search_block(queries, rows, k)
        query, score, row = found
        asked = queries["id"].to_numpy()[query] if len(queries) else query
        beyond = [(s >= 1 << 63) - (s < -1 << 63) for s in score.tolist()]
        whole = [None if b else s for s, b in zip(score.tolist(), beyond, strict=True)]
        return pa.table(
            {
                "query_id": pa.array(asked, pa.int64()),
                "vec_id": pa.array(row, pa.int64()),
                "score": pa.array(whole, pa.int64()),
                "beyond": pa.array(beyond, pa.int32()),
                "digits": pa.array([_digits(s) if b else None for s, b in zip(score.tolist(), beyond, strict=True)], pa.string()),
            }
        )

    keys = ["cell", "block", "part"]
    part = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        search, "query_id bigint, vec_id bigint, score bigint, beyond int, digits string"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("beyond"), F.desc("score"), F.desc("digits"), "vec_id")
    # A query has k rows per block pair at most.
    return (
        part.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
