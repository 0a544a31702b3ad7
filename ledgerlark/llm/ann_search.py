"""Operator 3: approximate nearest neighbours by an adaptive scan over dimensions.

Vectors lie in lists around centroids. In each probed list the rotated unit vectors lie in column
blocks. A scan adds up squared distances block by block; after each block a hypothesis test on the
partial distance decides whether a candidate can still be among the nearest, and drops it if not.
Survivors get their exact cosine, in double precision, from the original vectors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.vectors import distinct_values, ranked, usable_vectors
from ledgerlark.sources.scratch import stored

SAMPLE = 20_000  # bound of the sample that centroids are fitted on
LISTS = 2048  # bound of the number of lists, and so of the model sent along
PROBED = 0.65  # share of the lists that a query probes; vectors without clusters need this many
LEAST_PROBED = 16
BLOCK_ROWS, QUERY_ROWS = 16_384, 8_192
COLUMNS = 16  # dimensions in a column block
DOUBT = 2.1  # larger: fewer wrong drops, later drops


@dataclass(frozen=True)
class ListModel:
    centroids: np.ndarray
    rotation: np.ndarray
    probed: int

    def nearest(self, units: np.ndarray, n: int) -> np.ndarray:
        """The n nearest lists of each unit vector, nearest first."""
        near = units @ self.centroids.T - 0.5 * (self.centroids**2).sum(1)
        if n >= near.shape[1]:
            return np.argsort(-near, axis=1, kind="stable")
        part = np.argpartition(-near, n - 1, axis=1)[:, :n]
        order = np.argsort(-np.take_along_axis(near, part, 1), axis=1, kind="stable")
        return np.take_along_axis(part, order, 1)


def units_of(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # lengths can't overflow
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def fit_lists(distinct: DataFrame, rows: int, probed: float = PROBED) -> ListModel:
    """K-means on the ``SAMPLE`` vectors with the smallest hash; about sqrt(rows) lists."""
    share = min(1.0, 1.2 * SAMPLE / max(1, rows))
    sample = (
        distinct.select("vec", F.xxhash64("vec").alias("h"))
        .where(F.pmod("h", F.lit(1_000_003)) <= math.ceil(1_000_003 * share))
        .orderBy("h")
        .limit(SAMPLE)
        .select("vec")
        .collect()
    )
    units = units_of(np.array([r["vec"] for r in sample]))
    random = np.random.default_rng(7)
    lists = int(min(LISTS, max(1, round(math.sqrt(rows))), len(units)))
    centroids = units[random.choice(len(units), lists, replace=False)]
    for _ in range(10):
        own = (units @ centroids.T - 0.5 * (centroids**2).sum(1)).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, units)
        counts = np.bincount(own, minlength=lists)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(1, counts)[:, None], centroids)
    rotation, _ = np.linalg.qr(random.standard_normal((units.shape[1],) * 2))
    return ListModel(centroids, rotation, min(lists, max(LEAST_PROBED, math.ceil(probed * lists))))


def _matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1)


def scan(blocks: list[np.ndarray], query: np.ndarray, k: int) -> np.ndarray:
    """Places of (at least) the k nearest rows that the tests let through, exact distances last.

    ``blocks`` are the column blocks of the list's rows, ``query`` is rotated alike."""
    n, d = len(blocks[0]), len(query)
    parts, at = [], 0
    for b in blocks:
        parts.append(query[at : at + b.shape[1]])
        at += b.shape[1]
    bound, best, best_at = math.inf, np.zeros(0), np.zeros(0, np.int64)
    start, step = 0, 4 * k
    while start < n:
        alive = np.arange(start, min(n, start + step))
        partial, seen = np.zeros(len(alive)), 0
        for b, q in zip(blocks, parts, strict=True):
            partial = partial + ((b[alive] - q) ** 2).sum(1)
            seen += b.shape[1]
            if seen < d and bound < math.inf:
                may = partial * (d / seen) <= bound * (1 + DOUBT / math.sqrt(seen)) ** 2
                alive, partial = alive[may], partial[may]
                if not len(alive):
                    break
        if len(alive):
            best, best_at = np.concatenate([best, partial]), np.concatenate([best_at, alive])
            if len(best) > k:
                # Equal distances all stay, for the exact ranking.
                bound = np.partition(best, k - 1)[k - 1] * (1 + 1e-6) + 1e-12
                kept = best <= bound
                best, best_at = best[kept], best_at[kept]
        start, step = start + step, 4096
    return best_at


RESULT = "query struct<id: bigint, h: bigint>, found struct<id: bigint, h: bigint>, score double"


def nearest_vectors(
    table: DataFrame, queries, *, id: str = "vec_id", vector: str = "embedding", k: int = 5, probed: float = PROBED
) -> DataFrame:
    """For each row whose id fits ``queries`` (a function of the id column): query_id, rank, id, score.

    Candidates are all usable rows (see ``usable_vectors``) but those with the query's own id; the k
    nearest found by cosine, ties to the smaller id, all if there are fewer. Copies of a vector are
    searched once and ranked by id. No usable rows: no results.

    A list is cut into blocks of ``BLOCK_ROWS`` rows, and the queries that probe it into portions of
    ``QUERY_ROWS``; each pair of block and portion is a group of bounded size, however many vectors
    crowd around one centroid. The driver sees counts for each list only.
    """
    name = f"{id}"
    rows = usable_vectors(table, id=id, vector=vector)
    distinct = stored(distinct_values(rows, "vec", k + 1), "distinct-vectors")
    n = distinct.count()
    spark = table.sparkSession
    if not n:
        return spark.createDataFrame([], f"query_id bigint, rank int, {name} bigint, score double")
    asking = rows.where(queries(F.col("id"))).select(F.col("id").alias("query_id"), "vec")
    asking = stored(asking.join(distinct.select("vec", "vid"), "vec").select("query_id", "vid"), "asking")
    model = fit_lists(distinct, n, probed)
    sent = spark.sparkContext.broadcast(model)

    def deal(per_row: int):
        def run(batches):
            m = sent.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                vec = batch.column(1)
                lists = m.nearest(units_of(_matrix(vec)), min(per_row, len(m.centroids)))
                at = pa.array(np.repeat(np.arange(batch.num_rows), lists.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists.ravel().astype(np.int32)), batch.column(0).take(at), vec.take(at)],
                    names=["list", "vid", "vec"],
                )

        return run

    ddl = "list int, vid struct<id: bigint, h: bigint>, vec array<double>"
    index = stored(distinct.select("vid", "vec").mapInArrow(deal(1), ddl), "ann-index")
    wanted = distinct.select("vid", "vec").join(asking.select("vid").distinct(), "vid", "left_semi")
    probes = stored(wanted.mapInArrow(deal(model.probed), ddl), "ann-probes")
    # At most LISTS rows each.
    held = {r["list"]: r["count"] for r in index.groupBy("list").count().collect()}
    asked = {r["list"]: r["count"] for r in probes.groupBy("list").count().collect()}
    sizes = spark.createDataFrame(
        [(x, 1 + (c - 1) // BLOCK_ROWS, 1 + (asked[x] - 1) // QUERY_ROWS) for x, c in held.items() if x in asked] or [(-1, 1, 1)],
        "list int, blocks int, portions int",
    )

    def spread(df, own: str, other: str, query: bool):
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        dealt = df.join(F.broadcast(sizes), "list").withColumn("mine", F.pmod(F.xxhash64("vid"), F.col(own)).cast("int"))
        both = {"block": every if query else F.col("mine"), "portion": F.col("mine") if query else every}
        return dealt.select("list", *(c.alias(x) for x, c in both.items()), F.lit(query).alias("query"), "vid", "vec")

    grouped = spread(index, "blocks", "portions", False).unionByName(spread(probes, "portions", "blocks", True))

    def search(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        is_query = group.column("query").to_numpy()
        held, asked = group.filter(pa.array(~is_query)), group.filter(pa.array(is_query))
        out_q, out_f, scores = [], [], []
        if held.num_rows and asked.num_rows:
            m = sent.value
            vectors = _matrix(held.column("vec").combine_chunks())
            asking = _matrix(asked.column("vec").combine_chunks())
            units, turned_q = units_of(vectors), units_of(asking) @ m.rotation
            turned = (units @ m.rotation).astype(np.float32)
            blocks = [np.ascontiguousarray(turned[:, c : c + COLUMNS]) for c in range(0, turned.shape[1], COLUMNS)]
            lengths = np.linalg.norm(vectors, axis=1)
            for i in range(len(asking)):
                at = scan(blocks, turned_q[i].astype(np.float32), k + 1)
                exact = (vectors[at] @ asking[i]) / (lengths[at] * np.linalg.norm(asking[i]))
                out_q.append(np.full(len(at), i))
                out_f.append(at)
                scores.append(exact)
        q = np.concatenate(out_q) if out_q else np.zeros(0, np.int64)
        f = np.concatenate(out_f) if out_f else np.zeros(0, np.int64)
        return pa.table(
            {
                "query": asked.column("vid").take(pa.array(q)),
                "found": held.column("vid").take(pa.array(f)),
                "score": pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64()),
            }
        )

    hits = grouped.groupBy("list", "block", "portion").applyInArrow(search, RESULT)
    # The k + 1 nearest distinct vectors of a distinct query hold its k nearest rows.
    top = ranked(
        hits.withColumnRenamed("query", "query_id"), k + 1, F.desc("score"), F.col("found.id"), F.col("found.h")
    ).select(F.col("query_id").alias("vid"), "found", "score")
    rows_found = (
        asking.join(top, "vid")
        .join(distinct.select(F.col("vid").alias("found"), "ids"), "found")
        .select("query_id", "score", F.explode("ids").alias("hit"))
        .where(F.col("hit") != F.col("query_id"))
    )
    return ranked(rows_found, k, F.desc("score"), F.col("hit")).select(
        "query_id", "rank", F.col("hit").alias(name), "score"
    )
