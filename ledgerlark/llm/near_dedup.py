"""Operator 8: near-duplicates by ProbMinHash over sets of five-word shingles.

Each shingle sends a Poisson process of points with its weight as the rate; each point falls into a
random register, and a register keeps the shingle of its earliest point. Two documents agree in a
register with the probability of their shingles' probability Jaccard similarity. All shingles weigh
the same here, which makes that the Jaccard similarity of the sets. A shingle stops as
soon as its next point comes later than every register's earliest. Bands of registers propose pairs,
and the Jaccard similarity of the shingle sets themselves decides.
"""

from __future__ import annotations

from math import ceil, comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.columns import fresh, quoted
from ledgerlark.llm.components import components
from ledgerlark.sources.scratch import stored

WORDS = 5
SIMILAR = 0.8
REGISTERS, BANDS, ROWS = 256, 16, 4  # at 0.8 the first 64 registers make the bands
#: Share of the pairs just similar enough that share no band, and that the second round takes for less.
MISSED_BY_BANDS, MISSED_BY_COUNT = 0.00025, 0.001
FILTER_BITS = 1 << 26  # bound of the filter over documents to compare: 8 MB
BLOCK = 200  # documents of a bucket that are compared with as many others at a time
CHUNK = 2 << 20  # bytes of text whose shingles a worker holds at a time
PART = 256 << 10  # bytes of text that it hashes at a time, which takes fifty times as much memory
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1
_powers: dict[str, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i under n."""
    name = str(base)
    if name not in _powers or len(_powers[name]) < n:
        table = np.full(n, base, np.uint64)
        table[0] = 1
        _powers[name] = np.multiply.accumulate(table)
    return _powers[name]


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit number for each 64-bit number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def normal_form(text: str | None) -> bytes:
    """Lower case, words (runs without white space) parted by one blank."""
    return " ".join((text or "").lower().split()).encode()


def _stretches(data: bytes, words: int):
    """A very long text in parts that overlap by ``words`` - 1 words, so no shingle is lost or made twice.

    Each part has a shingle's words at least, however long they are, and the next begins at a later word."""
    blanks = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts, ends = np.concatenate([[0], blanks + 1]), np.concatenate([blanks, [len(data)]])
    first = 0
    while True:
        last = max(int(np.searchsorted(ends, starts[first] + PART)), first + words - 1)
        if last >= len(ends) - 1:
            break
        yield data[starts[first] : ends[last]]
        first = last - words + 2
    yield data[starts[first] :]


def shingle_hashes(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, count) of the distinct shingles of normal forms, sorted by the first two.

    A text with fewer words than a shingle is one shingle; one without words has none. Texts end where
    their lengths say, as U+0000 may stand in a word. Hashes have 48 bits."""
    owner = [i for i, t in enumerate(texts) if t]
    if not owner:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    data = np.frombuffer(b"\x00".join(texts[i] for i in owner) + b"\x00", np.uint8)
    n = len(data)
    limits = np.cumsum([len(texts[i]) + 1 for i in owner]) - 1
    gap = data == 32
    gap[limits] = True
    ends = np.flatnonzero(gap)
    starts = np.concatenate([[0], ends[:-1] + 1])
    text = np.searchsorted(limits, ends)
    powers, inverse = _power_table(BASE, n + 1), _power_table(pow(BASE, -1, 1 << 64), n + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n])])
    counts = np.bincount(text, minlength=len(owner))
    firsts = np.cumsum(counts) - counts
    long_from = np.flatnonzero(text[: max(0, len(text) - words + 1)] == text[words - 1 :])
    short = np.flatnonzero(counts < words)
    a = np.concatenate([starts[long_from], starts[firsts[short]]])
    b = np.concatenate([ends[long_from + words - 1], ends[firsts[short] + counts[short] - 1]])
    which = np.concatenate([text[long_from], short])
    value = mixed((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
    key = (which.astype(np.uint64) << np.uint64(48)) | (value >> np.uint64(16))
    key.sort()
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.concatenate([new, [len(key)]]))
    key = key[new]
    return np.array(owner)[(key >> np.uint64(48)).astype(np.int64)], key & np.uint64((1 << 48) - 1), count


def prob_minhash(text: np.ndarray, value: np.ndarray, weight: np.ndarray, texts: int, registers: int = REGISTERS) -> np.ndarray:
    """The shingle in each register of each text (texts x registers); rows without shingles are 0."""
    earliest = np.full(texts * registers, np.inf)
    holder = np.zeros(texts * registers, np.uint64)
    latest = np.full(texts, np.inf)
    at = np.zeros(len(value))
    seed = mixed(value + np.uint64(BASE & MASK))
    step = 0
    while len(value):
        step += 1
        drawn = mixed(seed + np.uint64(step * 0xD1342543DE82EF95 & MASK))
        at = at - np.log(((drawn >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / weight
        register = (mixed(drawn + np.uint64(1)) % np.uint64(registers)).astype(np.int64)
        place = text * registers + register
        np.minimum.at(earliest, place, at)
        holds = earliest[place] == at
        holder[place[holds]] = value[holds]
        some = np.flatnonzero(np.bincount(text, minlength=texts))
        latest[some] = earliest.reshape(texts, registers)[some].max(1)
        going = at < latest[text]
        text, value, weight, at, seed = text[going], value[going], weight[going], at[going], seed[going]
    return holder.reshape(texts, registers)


def band_keys(holder: np.ndarray, bands: int = BANDS, size: int = ROWS) -> np.ndarray:
    rows = holder[:, : bands * size].reshape(len(holder), bands, size)
    key = np.zeros(rows.shape[:2], np.uint64) + mixed(np.arange(1, bands + 1, dtype=np.uint64))
    for i in range(rows.shape[2]):
        key = mixed(key * np.uint64(BASE & MASK) + rows[:, :, i])
    return key.view(np.int64)


def banding(similar: float) -> tuple[int, int]:
    """(bands, rows): as many rows as let the registers propose pairs of this similarity surely enough."""
    if not 0 < similar <= 1:
        raise ValueError("the similarity must be above 0 and at most 1")
    for rows in range(ROWS, 0, -1):
        bands = 1 if similar == 1 else ceil(log(MISSED_BY_BANDS) / log(1 - similar**rows))
        if bands * rows <= REGISTERS:
            return bands, rows
    raise ValueError(f"{REGISTERS} registers are too few to find pairs of similarity {similar}")


def least_agreeing(similar: float) -> int:
    """Registers that must agree before two documents of a bucket are compared in the second round.

    For pairs at 0.8 the count is 205 on average with a spread of 6.4, so 0.0007 of them have fewer
    than 184."""
    fewer = 0.0
    for n in range(REGISTERS):
        fewer += comb(REGISTERS, n) * similar**n * (1 - similar) ** (REGISTERS - n)
        if fewer > MISSED_BY_COUNT:
            return n
    return REGISTERS


def _in_chunks(values):
    """Lists of (number in the batch, normal form) of about CHUNK bytes."""
    chunk, size = [], 0
    for i, value in enumerate(values):
        data = normal_form(value.as_py())
        if chunk and (size + len(data) > CHUNK or len(chunk) >= 60_000):
            yield chunk
            chunk, size = [], 0
        chunk.append((i, data))
        size += len(data)
    if chunk:
        yield chunk


def _parts(chunk):
    """Runs of texts of a chunk of about PART bytes: (place of the first, texts)."""
    first, part, size = 0, [], 0
    for i, (_, data) in enumerate(chunk):
        if part and size + len(data) > PART:
            yield first, part
            first, part, size = i, [], 0
        part.append(data)
        size += len(data)
    if part:
        yield first, part


def _long_shingles(data: bytes, words: int):
    """As ``shingle_hashes`` of one very long text, in stretches."""
    parts = [shingle_hashes([s], words) for s in _stretches(data, words)]
    value, back = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True)
    count = np.bincount(back, np.concatenate([p[2] for p in parts])).astype(np.int64)
    return np.zeros(len(value), np.int64), value, count


def _chunk_shingles(chunk, words: int):
    """As ``shingle_hashes`` over the texts of a chunk."""
    found = []
    for first, part in _parts(chunk):
        long = len(part) == 1 and len(part[0]) > 2 * PART
        text, value, count = _long_shingles(part[0], words) if long else shingle_hashes(part, words)
        found.append((text + first, value, count))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def node_of(text: Column) -> Column:
    """Equal texts, and no others, are one node."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def signatures(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, similar: float = SIMILAR
) -> DataFrame:
    """(doc_id, node, bands, agreed): the band keys and the low 8 bits of each register.

    A text without words has null bands. A shingle weighs 1 however often it is repeated: links are
    defined on sets, and weights by count would keep texts that differ in a refrain's length apart."""
    chosen = docs.select(quoted(doc_id).alias("doc_id"), node_of(quoted(text)).alias("node"), quoted(text).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    bands, size = banding(similar)

    def run(batches):
        for batch in batches:
            for chunk in _in_chunks(batch.column(2)):
                text, value, _ = _chunk_shingles(chunk, words)
                holder = prob_minhash(text, value, np.ones(len(value)), len(chunk))
                some = np.bincount(text, minlength=len(chunk)) > 0
                keys, low = band_keys(holder, bands, size), holder.astype(np.uint8).view(np.int8)
                rows = batch.slice(chunk[0][0], len(chunk))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        rows.column(1),
                        pa.array([k if s else None for k, s in zip(keys, some, strict=True)], pa.list_(pa.int64())),
                        pa.array([x if s else None for x, s in zip(low, some, strict=True)], pa.list_(pa.int8())),
                    ],
                    names=["doc_id", "node", "bands", "agreed"],
                )

    return chosen.mapInArrow(run, f"doc_id {kind}, node binary, bands array<bigint>, agreed array<tinyint>")


def _bitmap(rows: DataFrame, key: Column) -> np.ndarray:
    """Two bits for each key, in a filter of 16 bits a row but at most ``FILTER_BITS``: the driver gets
    the words of the bitmap. A full filter only lets more rows through."""
    bits = min(FILTER_BITS, max(1 << 16, 1 << (16 * rows.count()).bit_length()))
    at = rows.select(F.explode(F.array(*_places(key, bits))).alias("at"))
    words = at.groupBy(F.floor(F.col("at") / 32).cast("bigint").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at % 32 as int)))").alias("set")
    )
    found = words.toArrow()
    bitmap = np.zeros(bits // 32, np.uint32)
    bitmap[found.column("word").to_numpy()] = found.column("set").to_numpy().astype(np.uint32)
    return bitmap


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(key, F.lit(bits)), F.pmod(F.shiftrightunsigned(key, 32), F.lit(bits))]


def _shingles_of(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """(node, shingles) for the given rows (node, rep): sorted distinct hashes as bytes.

    A filter picks them where the texts are read, so texts are not shuffled. It may let others
    through, which later joins drop, and rows equal in id and text come more than once."""
    sent = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted, F.xxhash64("rep", "node")))
    bits = 32 * len(sent.value)
    chosen = docs.select(node_of(quoted(text)).alias("node"), quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    key = F.xxhash64("doc_id", "node")
    chosen = chosen.select("node", "text", *(c.alias(n) for c, n in zip(_places(key, bits), ("p", "q"), strict=True)))

    def run(batches):
        bitmap = sent.value
        for batch in batches:
            held = np.ones(batch.num_rows, bool)
            for i in (2, 3):
                p = batch.column(i).to_numpy()
                held &= (bitmap[p >> 5] >> (p & 31).astype(np.uint32)) & 1 == 1
            batch = batch.filter(pa.array(held))
            for chunk in _in_chunks(batch.column(1)):
                text, value, _ = _chunk_shingles(chunk, words)
                cuts = np.searchsorted(text, np.arange(len(chunk) + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.slice(chunk[0][0], len(chunk)).column(0),
                        pa.array([value[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    ],
                    names=["node", "shingles"],
                )

    return chosen.mapInArrow(run, "node binary, shingles binary")


def jaccard(one: bytes, two: bytes) -> float:
    """Of two sorted distinct hash lists; two empty ones have nothing in common."""
    a, b = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return both / (len(a) + len(b) - both)


def _verified(pairs: DataFrame, shingles: DataFrame, similar: float) -> DataFrame:
    # Joined the same way at every size; a node with very many pairs can be split.
    one = shingles.select(F.col("node").alias("a"), F.col("shingles").alias("one")).hint("merge")
    two = shingles.select(F.col("node").alias("b"), F.col("shingles").alias("two")).hint("merge")
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")

    def run(batches):
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            near = [jaccard(a[i].as_py(), b[i].as_py()) >= similar for i in range(batch.num_rows)]
            yield batch.filter(pa.array(near, pa.bool_())).select([0, 1])

    return both.mapInArrow(run, "a binary, b binary")


def _similar_links(docs, nodes, pairs, doc_id, text, words, similar) -> DataFrame:
    pairs = stored(pairs, "pairs")
    named = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = stored(named.join(nodes.select("node", "rep"), "node"), "nodes-compared")
    shingles = stored(_shingles_of(docs, wanted, doc_id, text, words), "shingles")
    return stored(_verified(pairs, shingles, similar), "near-links")


def near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, similar: float = SIMILAR
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, node (its text's digest), class_id, root (the class's
    smallest node, which names it uniquely), worded.

    Texts are linked if their sets of five-word shingles (lower case, white space as one blank) have a
    Jaccard similarity of at least ``similar``; linked texts, directly or through others, and equal
    texts are a class. class_id is the class's smallest doc_id. A text without words is a class of
    its own row, takes its own doc_id and has no root. Null ids come last as class_id. Repeated rows are rows of
    one class. An empty table gives none.

    Equal texts are one node from the start. In the first round each bucket compares one node, the one
    that meets most others over all its buckets, with the rest: a text with thousands of near copies
    takes as many comparisons, not their square. In the second round nodes of a bucket that are still in different classes are
    compared, all of them, in blocks of ``BLOCK`` by ``BLOCK``; only those that agree in enough
    registers and are not in one class already become pairs. So no cap is put on a bucket. Bands and
    register count are those for ``similar``; one too low for the registers (under 0.04) raises.
    """
    found = stored(signatures(docs, doc_id=doc_id, text=text, words=words, similar=similar), "signatures")
    worded = found.where(F.col("bands").isNotNull())
    nodes = stored(
        worded.groupBy("node").agg(
            F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("agreed").alias("agreed")
        ),
        "nodes",
    )
    members = nodes.select("node", F.explode("bands").alias("band"))
    sizes = stored(members.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    shared = stored(members.join(sizes, "band"), "shared-buckets")
    # The text that others were copied from meets more of them than they meet each other.
    met = stored(shared.groupBy("node").agg(F.sum("size").alias("met")), "met")
    first = shared.join(met, "node").groupBy("band").agg(F.max(F.struct("met", "node"))["node"].alias("first"))
    firsts = stored(first, "firsts")
    pairs = (
        shared.join(firsts, "band")
        .where(F.col("node") != F.col("first"))
        .select(F.least("first", "node").alias("a"), F.greatest("first", "node").alias("b"))
    )
    links = _similar_links(docs, nodes, pairs.distinct(), doc_id, text, words, similar)
    roots = stored(components(links), "roots")

    rooted = shared.join(roots, "node", "left").select("band", "size", "node", F.coalesce("root", "node").alias("root"))
    mixed_buckets = rooted.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed_buckets = stored(mixed_buckets.where("low != high").select("band"), "mixed-buckets")
    open_rows = stored(
        rooted.join(mixed_buckets, "band").join(nodes.select("node", "agreed", "bands"), "node"), "open-rows"
    )
    more = _block_pairs(open_rows, least_agreeing(similar))
    further = _similar_links(docs, nodes, more, doc_id, text, words, similar)
    roots = stored(components(links.union(further)), "roots")

    classes = nodes.join(roots, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
    least = stored(classes.groupBy("root").agg(F.min("rep").alias("class_id")), "classes")
    named = stored(classes.join(least, "root").select("node", "root", "class_id"), "class-of-node")
    return found.select("doc_id", "node", F.col("bands").isNotNull().alias("worded")).join(named, "node", "left").select(
        "doc_id",
        "node",
        F.when(F.col("worded"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        "root",
        "worded",
    )


def _block_pairs(rows: DataFrame, least: int) -> DataFrame:
    """Pairs of nodes of one bucket and different roots that agree in enough registers."""
    blocks = (1 + F.floor(F.col("size") / BLOCK)).cast("int")
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    dealt = dealt.select(
        "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "node", "root", "agreed", "bands",
    )
    one, two = dealt.alias("one"), dealt.alias("two")
    agree = F.size(
        F.filter(F.zip_with(F.col("one.agreed"), F.col("two.agreed"), lambda x, y: x == y), lambda same: same)
    )
    met = (
        (F.col("one.band") == F.col("two.band")) & (F.col("one.i") == F.col("two.i")) & (F.col("one.j") == F.col("two.j"))
        & (F.col("one.node") < F.col("two.node")) & (F.col("one.root") != F.col("two.root"))
        & ((F.col("one.i") == F.col("one.j")) | (F.col("one.block") != F.col("two.block")))
        & (agree >= least)
        # Of the buckets that two nodes share, one makes their pair.
        & (F.array_min(F.array_intersect("one.bands", "two.bands")) == F.col("one.band"))
    )
    return one.join(two, met).select(F.col("one.node").alias("a"), F.col("two.node").alias("b"))


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, one for each class: the one with the smallest doc_id.

    Classes go by their root: ids may be null, or stand on several texts. Rows without words all stay,
    but for repeats equal in id and text."""
    found = stored(near_duplicates(docs, doc_id=doc_id, text=text, **options), "near-classes")
    winners = found.where("worded").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("node"))).alias("w")
    )
    keep = winners.select("w.doc_id", "w.node").union(found.where("not worded").select("doc_id", "node").distinct())
    names = [fresh(docs, "kept_id"), fresh(docs, "kept_node"), fresh(docs, "own_node")]
    keep = stored(keep.select(F.col("doc_id").alias(names[0]), F.col("node").alias(names[1])), "near-kept")
    dealt = docs.withColumn(names[2], node_of(quoted(text)))
    kept = dealt.join(
        keep, (F.col(names[2]) == F.col(names[1])) & quoted(doc_id).eqNullSafe(F.col(names[0])), "left_semi"
    )
    repeats = found.groupBy("doc_id", "node").count().where("count > 1")
    if not repeats.join(keep, (repeats["node"] == keep[names[1]]) & repeats["doc_id"].eqNullSafe(keep[names[0]]), "left_semi").isEmpty():
        kept = kept.dropDuplicates([doc_id, names[2]])
    return kept.drop(names[2])
