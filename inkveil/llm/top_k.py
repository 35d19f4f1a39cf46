"""Exact search for the rows of greatest inner product by MaxScore.

Components become whole numbers floor(scale * x). A dimension has two postings, of its positive and its negative
components; a query term goes through the one that adds to the score, the other can only lower it and has bound 0.

Queries go out in blocks of `block` rows, a block to all tasks at once; each task cuts its candidates into shards of
`shard_rows`, indexes a shard, and for each query of the block

1. takes the bound of every term (its weight times the shard's greatest component) and the score to beat: the k-th
   best so far, of earlier shards and of the rows that the strongest term likes best;
2. calls the weakest terms non-essential whose bounds together stay below that score: a row that only they hold
   cannot come in. The postings of the others are traversed, which gives each row's share of them;
3. probes the components left for rows still competitive: first those that lower the score, then the non-essential
   terms, strongest first; rows whose share and open bounds fall below the score to beat are left at each step.

Ties are competitive, so results are exact: greatest score first, then smallest id. A task sends its k best of each
query, and those are merged, so neither driver nor a task holds more than a block of queries or a shard of rows.

Vectors that are null or hold null or non-finite components take no part; an empty one has score 0 with all, and
components that a shorter vector lacks are 0. A null id comes after all others and is no query. A query's own row is
left out, not others that repeat its id; rows that repeat a query's id are queries of their own. Sums must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkveil.session import scratch_dir, staged

NO_ID = 2**63 - 1
FOUND = "query long, vec_id long, r long, score long"


@dataclass(frozen=True)
class TopKParams:
    k: int = 5
    scale: float = 256.0
    #: Rows whose id this divides are queries.
    every: int = 50
    block: int = 4096
    shard_rows: int = 1 << 15


def vectors(table: DataFrame, params: TopKParams = TopKParams()) -> DataFrame:
    """r (a number of the row), vec_id and v, the components as whole numbers."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(x, lambda c: F.floor(F.lit(params.scale) * c.cast("double")).cast("long"))
    return table.where(x.isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.monotonically_increasing_id().alias("r"), F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"),
        scaled.alias("v"))


def _matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of components; shorter ones are filled with 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = np.diff(column.offsets.to_numpy()).astype(np.int64)
    found = np.zeros((len(n), max(width, int(n.max(initial=0)))), np.int64)
    found[np.arange(found.shape[1]) < n[:, None]] = column.flatten().to_numpy()
    return found


class Shard:
    """An index of some rows: for each dimension and sign the rows that have it, their components and the greatest."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, values: np.ndarray):
        order = np.lexsort((rows, ids))
        self.ids, self.rows, self.values = ids[order], rows[order], values[order]
        self.place = {r: i for i, r in enumerate(self.rows.tolist())}
        self.postings = []
        for component in self.values.T:
            signs = (np.flatnonzero(component > 0), np.flatnonzero(component < 0))
            self.postings.append([(at, size, int(size.max(initial=0))) for at in signs for size in (np.abs(component[at]),)])

    def best(self, query: np.ndarray, own: int, floor: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of rows that may be among the query's k best, at least those that are and reach `floor`
        (None: nothing is to be beaten yet)."""
        skip = self.place.get(own, -1)
        terms = np.flatnonzero(query)
        weights = np.abs(query[terms])
        lists = [self.postings[d][int(query[d] < 0)] for d in terms.tolist()]
        bounds = weights * np.array([top for _, _, top in lists], np.int64)
        order = np.argsort(bounds, kind="stable")
        floor = self._seeded(query, lists[order[-1]] if len(order) else None, skip, floor, k)
        below = np.cumsum(bounds[order])
        n_weak = int(np.searchsorted(below, floor, "left")) if floor is not None else 0
        weak, strong = order[:n_weak], order[n_weak:]
        share = np.zeros(len(self.ids), np.int64)
        if floor is None or floor <= 0:  # a row without any posting has score 0 and may come in
            live = np.ones(len(self.ids), bool)
        else:
            live = np.zeros(len(self.ids), bool)
            for t in strong.tolist():
                live[lists[t][0]] = True
        for t in strong.tolist():
            at, size, _ = lists[t]
            share[at] += weights[t] * size
        if skip >= 0:
            live[skip] = False
        open_ = int(below[n_weak - 1]) if n_weak else 0
        least = np.iinfo(np.int64).min if floor is None else floor
        at = np.flatnonzero(live & (share + open_ >= least))
        share = share[at]
        for dims in np.array_split(terms[strong], 4):  # components of the other sign
            share += np.minimum(self.values[np.ix_(at, dims)] * query[dims], 0).sum(axis=1)
            keep = share + open_ >= least
            at, share = at[keep], share[keep]
        for t in weak[::-1].tolist():
            share += self.values[at, terms[t]] * query[terms[t]]
            open_ -= int(bounds[t])
            keep = share + open_ >= least
            at, share = at[keep], share[keep]
        first = np.lexsort((at, -share))[:k]  # rows stand by id
        return at[first], share[first]

    def _seeded(self, query: np.ndarray, strongest, skip: int, floor: int | None, k: int) -> int | None:
        """The k-th score of the rows that the strongest term likes best, where that beats `floor`."""
        if strongest is None or len(strongest[0]) <= k:
            return floor
        at, size, _ = strongest
        at = at[np.argpartition(-size, k)[:k + 1]]
        at = at[at != skip]
        scores = np.sort(self.values[at] @ query)[::-1]
        if len(scores) < k:
            return floor
        return int(scores[k - 1]) if floor is None else max(floor, int(scores[k - 1]))


def search(shards: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], query_rows: np.ndarray, queries: np.ndarray, k: int
           ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(query row, id, row, score) of each query's k best over all shards of (ids, rows, components)."""
    n = len(query_rows)
    scores, ids, rows = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)
    have = np.zeros(n, np.int64)
    for shard_ids, shard_rows, values in shards:
        width = max(values.shape[1], queries.shape[1])
        wide = lambda x: np.pad(x, ((0, 0), (0, width - x.shape[1])))
        shard, queries = Shard(shard_ids, shard_rows, wide(values)), wide(queries)
        for q in range(n):
            m = int(have[q])
            at, score = shard.best(queries[q], int(query_rows[q]), int(scores[q, k - 1]) if m == k else None, k)
            if not len(at):
                continue
            s, i, r = np.r_[scores[q, :m], score], np.r_[ids[q, :m], shard.ids[at]], np.r_[rows[q, :m], shard.rows[at]]
            top = np.lexsort((r, i, -s))[:k]
            have[q] = len(top)
            scores[q, :len(top)], ids[q, :len(top)], rows[q, :len(top)] = s[top], i[top], r[top]
    for q in range(n):
        m = int(have[q])
        yield np.full(m, query_rows[q]), ids[q, :m], rows[q, :m], scores[q, :m]


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - n)
            held.append(part)
            n, batch = n + part.num_rows, batch.slice(part.num_rows)
            if n == size:
                yield _arrays(held)
                held, n = [], 0
    if n:
        yield _arrays(held)


def _arrays(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = pa.Table.from_batches(held)
    return rows.column("vec_id").to_numpy(), rows.column("r").to_numpy(), _matrix(rows.column("v"))


def _search(batches: Iterator[pa.RecordBatch], block, params: TopKParams) -> Iterator[pa.RecordBatch]:
    query_rows, queries = block.value
    found = list(search(_shards(batches, params.shard_rows), query_rows, queries, params.k))
    if found:
        columns = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["query", "vec_id", "r", "score"])


def top_k(table: DataFrame, params: TopKParams = TopKParams()) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best rows of each query; `table` needs vec_id and embedding."""
    spark = table.sparkSession
    rows = staged(vectors(table, params), "vectors")
    is_query = (F.col("vec_id") != NO_ID) & (F.col("vec_id") % params.every == 0)
    blocks = -(-rows.where(is_query).count() // params.block)
    queries = scratch_dir(spark, "query-blocks")
    rows.where(is_query).withColumn("block", F.pmod(F.xxhash64("r"), F.lit(max(blocks, 1)))) \
        .repartition("block").write.partitionBy("block").parquet(queries)
    tasks = max(spark.sparkContext.defaultParallelism, rows.count() // params.shard_rows)
    candidates = staged(rows.repartition(tasks), "candidates")
    best = scratch_dir(spark, "best")
    spark.createDataFrame([], FOUND).write.parquet(best)
    for n in range(blocks):  # a block has about `block` rows, whatever the table's
        block = spark.read.parquet(f"{queries}/block={n}").select("r", "v").toArrow()
        sent = spark.sparkContext.broadcast((block.column("r").to_numpy(), _matrix(block.column("v"))))
        candidates.mapInArrow(partial(_search, block=sent, params=params), FOUND).write.mode("append").parquet(best)
        sent.unpersist()
    merged = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "r")
    ranked = spark.read.schema(FOUND).parquet(best).withColumn("rank", F.row_number().over(merged)).where(F.col("rank") <= params.k)
    named = rows.where(is_query).select(F.col("r").alias("query"), F.col("vec_id").alias("query_id"))
    return ranked.join(named, "query").select(
        "query_id", "rank", F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id"), "score")
