"""Operator 6: exact top-k search over binary codes by incremental multi-index hashing.

A code is cut into segments, and each segment has an index from its value to codes. A query looks
up all segment values within radius 0, then 1, and so on, one segment after the other, and measures
the full distance of what it finds. After segment j at radius r every code within m * r + j bits
has been found (m segments, j from 0), since a farther segment everywhere makes a larger sum. The
search ends when the k-th distance found is within that bound.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.vectors import distinct_values, ranked, usable_vectors
from ledgerlark.sources.scratch import stored

SHARD_ROWS, QUERY_ROWS = 65_536, 2_048
MOST_TASKS = 20_000
MOST_SEGMENT_BITS = 16


def sign_codes(table: DataFrame, *, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, code): a bit for each component, set where it is above zero, packed into bytes."""
    rows = usable_vectors(table, id=id, vector=vector, allow_zero=True)

    def run(batches):
        for batch in batches:
            vec = batch.column(1)
            if not batch.num_rows:
                continue
            bits = vec.flatten().to_numpy(zero_copy_only=False).reshape(len(vec), -1) > 0
            packed = np.packbits(bits, axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([row.tobytes() for row in packed], pa.binary())], names=["id", "code"]
            )

    return rows.mapInArrow(run, "id bigint, code binary")


@lru_cache(maxsize=32)
def values_by_weight(bits: int) -> list[np.ndarray]:
    """All values of so many bits, by the number of bits set."""
    values = np.arange(1 << bits, dtype=np.int64)
    weights = np.bitwise_count(values)
    return [values[weights == w] for w in range(bits + 1)]


class SegmentIndex:
    """Codes of one shard under the values of each segment."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes  # rows x bytes
        bits = 8 * codes.shape[1]
        width = int(min(MOST_SEGMENT_BITS, max(4, np.log2(max(2, len(codes))))))
        self.count = -(-bits // width)
        edges = np.linspace(0, bits, self.count + 1).round().astype(int)
        self.widths = np.diff(edges)
        self.edges = edges
        self.order, self.starts = [], []
        for value, size in zip(self.segments(codes), self.widths, strict=True):
            order = np.argsort(value, kind="stable")
            self.order.append(order)
            self.starts.append(np.searchsorted(value[order], np.arange((1 << int(size)) + 1)))
        padded = np.zeros((len(codes), -(-codes.shape[1] // 8) * 8), np.uint8)
        padded[:, : codes.shape[1]] = codes
        self.words = padded.view(np.uint64)

    def segments(self, codes: np.ndarray) -> list[np.ndarray]:
        bits = np.unpackbits(codes, axis=1)
        return [
            bits[:, a:b].astype(np.int64) @ (1 << np.arange(b - a, dtype=np.int64)[::-1])
            for a, b in zip(self.edges, self.edges[1:])
        ]

    def search(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances of all codes within the k-th smallest distance, ties included."""
        values = [int(v[0]) for v in self.segments(query[None, :])]
        padded = np.zeros(self.words.shape[1] * 8, np.uint8)
        padded[: len(query)] = query
        word = padded.view(np.uint64)
        seen = np.zeros(len(self.codes), bool)
        places, distances = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        n = 0
        for radius in range(int(self.widths.max()) + 1):
            for j in range(self.count):
                size = int(self.widths[j])
                if radius <= size:
                    keys = values[j] ^ values_by_weight(size)[radius]
                    low, high = self.starts[j][keys], self.starts[j][keys + 1]
                    some = high > low
                    low, lengths = low[some], (high - low)[some]
                    if len(low):
                        first = np.cumsum(lengths) - lengths
                        at = np.arange(lengths.sum()) + np.repeat(low - first, lengths)
                        found = self.order[j][at]
                        found = found[~seen[found]]
                        seen[found] = True
                        places.append(found)
                        distances.append(np.bitwise_count(self.words[found] ^ word).sum(1).astype(np.int64))
                        n += len(found)
                if n >= min(k, len(self.codes)):
                    all_d = np.concatenate(distances)
                    kth = np.partition(all_d, min(k, n) - 1)[min(k, n) - 1]
                    if kth <= self.count * radius + j or n == len(self.codes):
                        near = all_d <= kth
                        return np.concatenate(places)[near], all_d[near]
        return np.concatenate(places), np.concatenate(distances)


RESULT = "query binary, vid struct<id: bigint, h: bigint>, distance int"


def nearest_codes(codes: DataFrame, queries, *, k: int = 10, name: str = "vec_id") -> DataFrame:
    """For each row of (id, code) whose id fits ``queries``: query_id, rank, ``name``, distance.

    The k rows with the smallest Hamming distance, ties to the smaller id, without those of the
    query's own id; all if there are fewer. Exact. Null ids and codes take no part; of several code
    lengths those of the query's length count. Equal rows count once; equal codes are searched once.
    An empty table gives no results.

    Distinct codes are dealt into shards of about ``SHARD_ROWS``, distinct queries into portions of
    about ``QUERY_ROWS``. Every portion meets the index of every shard, so no group's work grows with
    the table; an index and a batch of queries are in memory, nothing else. The nearest of all shards
    together are the nearest of all.
    """
    spark = codes.sparkSession
    rows = codes.select("id", "code").where("id is not null and code is not null and length(code) > 0").distinct()
    distinct = stored(distinct_values(rows, "code", k + 1), "distinct-codes")
    n = distinct.count()
    shards = 1 + n // SHARD_ROWS
    asking = stored(rows.where(queries(F.col("id"))).select(F.col("id").alias("query_id"), "code"), "asking")
    asked = stored(asking.select("code").distinct(), "asked-codes")
    portions = 1 + asked.count() // QUERY_ROWS

    def every(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    held = distinct.select(
        F.pmod(F.xxhash64("vid"), F.lit(shards)).cast("int").alias("shard"),
        every(portions).alias("portion"),
        F.lit(False).alias("asks"),
        "vid",
        "code",
    )
    sent = asked.select(
        every(shards).alias("shard"),
        F.pmod(F.xxhash64("code"), F.lit(portions)).cast("int").alias("portion"),
        F.lit(True).alias("asks"),
        F.lit(None).cast("struct<id: bigint, h: bigint>").alias("vid"),
        "code",
    )
    met = (
        held.unionByName(sent)
        .withColumn("size", F.length("code"))
        .repartition(min(MOST_TASKS, shards * portions), "shard", "portion", "size")
        .sortWithinPartitions("shard", "portion", "size", "asks")
    )

    def run(batches):
        key, waiting, index = None, [], None
        for batch in batches:
            shard, portion, asks, code, size = (batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5))
            vid_id, vid_h = batch.column(3).flatten()
            out_q, out_v, out_h, out_d = [], [], [], []
            for i in range(batch.num_rows):
                if (shard[i], portion[i], size[i]) != key:
                    key, waiting, index = (shard[i], portion[i], size[i]), [], None
                if not asks[i]:
                    waiting.append((code[i], vid_id[i].as_py(), vid_h[i].as_py()))
                    continue
                if index is None and waiting:
                    codes, ids, hashes = zip(*waiting, strict=True)
                    ids, hashes = np.array(ids, np.int64), np.array(hashes, np.int64)
                    index = SegmentIndex(np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1))
                if index is None:
                    continue
                at, distance = index.search(np.frombuffer(code[i], np.uint8), k + 1)
                # Of ties, the smallest ids suffice.
                order = np.lexsort((hashes[at], ids[at], distance))[: k + 1]
                at, distance = at[order], distance[order]
                out_q += [code[i]] * len(at)
                out_v.append(ids[at])
                out_h.append(hashes[at])
                out_d.append(distance)
            if not out_q:
                continue
            found = [pa.array(np.concatenate(x)) for x in (out_v, out_h)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out_q, pa.binary()),
                    pa.StructArray.from_arrays(found, names=["id", "h"]),
                    pa.array(np.concatenate(out_d).astype(np.int32)),
                ],
                names=["query", "vid", "distance"],
            )

    hits = met.mapInArrow(run, RESULT)
    top = ranked(hits.withColumnRenamed("query", "query_id"), k + 1, F.col("distance"), F.col("vid.id"), F.col("vid.h"))
    top = top.select(F.col("query_id").alias("code"), "vid", "distance")
    found = (
        asking.join(top, "code")
        .join(distinct.select("vid", "ids"), "vid")
        .select("query_id", "distance", F.explode("ids").alias("hit"))
        .where(F.col("hit") != F.col("query_id"))
    )
    return ranked(found, k, F.col("distance"), F.col("hit")).select(
        "query_id", "rank", F.col("hit").alias(name), "distance"
    )
