"""Operator 9: lines that many documents share, found through two Bloom filters.

The first filter holds the hashes of lines seen once, the second those seen in a second document.
Lines that the second filter does not hold are unique for certain and never shuffled. The suspects
are counted exactly by their text, and each line found often enough stays in one document only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.columns import fresh, quoted
from ledgerlark.sources.scratch import stored

WHITE = b" \t\n\x0b\x0c\r"  # fixed values: the characters 0x20 and 0x09 to 0x0D
SHARD_BITS = 1 << 19
MOST_BITS = 1 << 30  # 128 MB a filter; beyond what this suits, more lines are suspected, none is lost
BITS_A_LINE = 6


def line_key(line: bytes) -> bytes:
    """Stripped of ASCII white space, A-Z lower-cased (bytes.lower touches nothing else)."""
    return line.strip(WHITE).lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (key.isascii() or len(key.decode()) >= least)


def _keys_of(text: str | None, least: int) -> dict[bytes, list[int]]:
    """The keys of a text with the numbers of their lines."""
    found: dict[bytes, list[int]] = {}
    for number, line in enumerate((text or "").encode().split(b"\n")):
        if len(line) >= least and _long_enough(key := line_key(line), least):
            found.setdefault(key, []).append(number)
    return found


def _positions(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def _hashes(keys) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64)


def filter_bits(chars: int) -> int:
    """A power of two for a table of so many code points, the same rule at every size."""
    lines = max(1, chars // 100)
    return min(MOST_BITS, max(SHARD_BITS, 1 << int(BITS_A_LINE * lines - 1).bit_length()))


def seen_twice(docs: DataFrame, text: str, least: int, bits: int) -> DataFrame:
    """The second filter in pieces: (shard, bitmap).

    A task notes the bits of its own distinct lines, and apart those of lines that two of its
    documents hold. Where tasks meet, a bit noted by both counts as seen twice. That is a superset
    of the bits of every line that two documents hold, so no repeat escapes.
    """

    def note(batches):
        once, twice = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        waiting: list[np.ndarray] = []
        held = 0

        def merged(once, twice):
            values, counts = np.unique(np.concatenate([*waiting, once, once[:0]]), return_counts=True)
            return values, np.union1d(twice, values[counts > 1])

        for batch in batches:
            for value in batch.column(0):
                keys = _keys_of(value.as_py(), least)
                if keys:
                    waiting.append(_hashes(keys))
                    held += len(keys)
            if held > 1_000_000:
                once, twice = merged(once, twice)
                waiting, held = [], 0
                if len(once) > 4_000_000:  # a very large task reports in parts
                    yield from _noted(once, twice, bits)
                    once, twice = once[:0], twice[:0]
        once, twice = merged(once, twice)
        yield from _noted(once, twice, bits)

    def merge(batches):
        shards: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for shard, one, two in zip(*(batch.column(i) for i in range(3)), strict=True):
                once, twice = shards.setdefault(
                    shard.as_py(), (np.zeros(SHARD_BITS, bool), np.zeros(SHARD_BITS, bool))
                )
                at = np.frombuffer(one.as_py(), np.uint32)
                twice[at[once[at]]] = True
                once[at] = True
                twice[np.frombuffer(two.as_py(), np.uint32)] = True
        for shard, (_, twice) in shards.items():
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "bitmap": pa.array([np.packbits(twice).tobytes()], pa.binary())}
            )

    noted = docs.select(quoted(text)).mapInArrow(note, "shard int, one binary, two binary")
    tasks = max(1, min(bits // SHARD_BITS, 256))
    return noted.repartition(tasks, "shard").mapInArrow(merge, "shard int, bitmap binary")


def _noted(once: np.ndarray, twice: np.ndarray, bits: int):
    one, two = (np.unique(np.concatenate(_positions(h, bits))) for h in (once, twice))
    edges = np.arange(0, bits + 1, SHARD_BITS, dtype=np.uint64)
    a, b = np.searchsorted(one, edges), np.searchsorted(two, edges)
    rows = [
        (i, *((part - edges[i]).astype(np.uint32).tobytes() for part in (one[a[i] : a[i + 1]], two[b[i] : b[i + 1]])))
        for i in range(len(edges) - 1)
        if a[i + 1] > a[i] or b[i + 1] > b[i]
    ]
    for i in range(0, len(rows), 64):
        shard, x, y = zip(*rows[i : i + 64], strict=True)
        yield pa.RecordBatch.from_pydict(
            {"shard": pa.array(shard, pa.int32()), "one": pa.array(x, pa.binary()), "two": pa.array(y, pa.binary())}
        )


def row_key(doc_id: Column, text: Column) -> Column:
    """Tells rows apart that share a doc_id; equal rows may share a key, as they lose equal lines."""
    return F.xxhash64(doc_id, text)


def shared_lines(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least_chars: int = 40, least_docs: int = 5
) -> DataFrame:
    """What to drop: (doc_id, row, lines), the line numbers that a row loses.

    Rows of one doc_id are one document, and so are all rows without one. A key held by
    ``least_docs`` documents or more stays in the rows with the largest doc_id that hold it (all its
    lines there) and goes everywhere else; a null doc_id never wins over others.
    """
    spark = docs.sparkSession
    chosen = docs.select(
        quoted(doc_id).alias("doc_id"), row_key(quoted(doc_id), quoted(text)).alias("row"), quoted(text).alias("text")
    )
    chars = chosen.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = filter_bits(chars)
    # At most MOST_BITS / 8 bytes in all, whatever the table holds.
    pieces = stored(seen_twice(chosen, "text", least_chars, bits), "lines-seen-twice").collect()
    bitmap = np.zeros(bits // 8, np.uint8)
    for piece in pieces:
        part = np.frombuffer(piece["bitmap"], np.uint8)
        bitmap[piece["shard"] * len(part) : (piece["shard"] + 1) * len(part)] = part
    sent = spark.sparkContext.broadcast(bitmap)

    def suspects(batches):
        bitmap = sent.value
        for batch in batches:
            ids, rows, texts = (batch.column(i) for i in range(3))
            at, keys, numbers = [], [], []
            for i in range(batch.num_rows):
                for key, lines in _keys_of(texts[i].as_py(), least_chars).items():
                    at.append(i)
                    keys.append(key)
                    numbers.append(lines)
            held = np.ones(len(keys), bool)
            for position in _positions(_hashes(keys), bits):
                p = position.astype(np.int64)
                held &= (bitmap[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1 == 1
            kept = np.flatnonzero(held)
            where = pa.array(np.array(at, np.int64)[kept])
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(where),
                    rows.take(where),
                    pa.array([keys[i].decode() for i in kept], pa.string()),
                    pa.array([numbers[i] for i in kept], pa.list_(pa.int32())),
                ],
                names=["doc_id", "row", "key", "lines"],
            )

    kind = chosen.schema["doc_id"].dataType.simpleString()
    found = stored(
        chosen.mapInArrow(suspects, f"doc_id {kind}, row bigint, key string, lines array<int>"), "line-suspects"
    )
    repeated = stored(
        found.groupBy("key")
        .agg(
            (F.count_distinct("doc_id") + F.max(F.col("doc_id").isNull().cast("int"))).alias("docs"),
            F.max("doc_id").alias("keeper"),
        )
        .where((F.col("docs") >= least_docs) & F.col("keeper").isNotNull())
        .select("key", "keeper"),
        "lines-repeated",
    )
    losing = found.join(repeated, "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return losing.groupBy("doc_id", "row").agg(
        F.array_distinct(F.flatten(F.collect_list("lines"))).alias("lines")
    )


def drop_shared_lines(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least_chars: int = 40, least_docs: int = 5
) -> DataFrame:
    """Every row of ``docs`` with its text cut to the lines it keeps, and ``n_lines`` (before) and
    ``n_dropped`` added (with underscores where those names are taken).

    Texts split at ``\\n``; the lines that stay are joined by it. A null text is one empty line and
    becomes empty. Blank lines and lines under ``least_chars`` code points always stay. See
    ``shared_lines`` for repeated rows and null ids. An empty table gives an empty table.
    """
    drops = shared_lines(docs, doc_id=doc_id, text=text, least_chars=least_chars, least_docs=least_docs)
    names = [fresh(docs, name) for name in ("n_lines", "n_dropped", "lost_id", "lost_row", "lost_lines")]
    n_lines, n_dropped, lost_id, lost_row, lost = names
    drops = drops.select(
        F.col("doc_id").alias(lost_id), F.col("row").alias(lost_row), F.col("lines").alias(lost)
    )
    joined = docs.join(
        drops,
        (row_key(quoted(doc_id), quoted(text)) == F.col(lost_row)) & quoted(doc_id).eqNullSafe(F.col(lost_id)),
        "left",
    ).drop(lost_id, lost_row)
    # One text's own lines: split, drop by number, join again; all inside the scan's JVM stage.
    whole = F.coalesce(quoted(text), F.lit(""))
    lines = F.split(whole, "\n", -1)
    kept = F.filter(lines, lambda line, i: ~F.coalesce(F.array_contains(quoted(lost), i), F.lit(False)))
    few = F.size(quoted(lost)) > 0
    return joined.select(
        *(
            F.when(few, F.array_join(kept, "\n")).otherwise(whole).alias(c) if c == text else quoted(c)
            for c in docs.columns
        ),
        (F.length(whole) - F.length(F.replace(whole, F.lit("\n"))) + 1).cast("bigint").alias(n_lines),
        F.when(quoted(lost).isNull(), 0).otherwise(F.size(quoted(lost))).cast("bigint").alias(n_dropped),
    )

