"""Operator 11: phrases whose words stand together more often than their parts would by chance.

Texts become shards of word numbers. The words of all shards meet in blocks by their hash; those seen
often enough get ids, and each shard gets back those of its own words, so no table of words is sent
whole anywhere. Phrases are then counted one length
after the other. A phrase can only be frequent if both phrases within it that lack one word are, so a
length looks only where the one before was frequent. Each shard packs the word ids of its phrases into
keys and counts them in quotient filters (see ``quotient_filter``), one for each block of the key
space. Where the filters of a block meet they are merged, and each shard gets back one bit for each
of its keys: frequent or not. All counters are exact.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlark.llm import quotient_filter
from ledgerlark.llm.columns import quoted
from ledgerlark.llm.quotient_filter import KeySpace
from ledgerlark.sources.scratch import stored

BREAKS = b".,;:!?\n\x0b\x0c\r"  # fixed values: the characters between pieces
BLANKS = b" \t"  # fixed values: the characters between words
TO_BREAKS = bytes.maketrans(BREAKS + BLANKS, b"." * len(BREAKS) + b" " * len(BLANKS))
SHARD_BYTES, HELD_BYTES = 12_000_000, 32_000_000
BLOCK_WORDS, BLOCK_ENTRIES = 1 << 17, 1 << 20
WORD_BITS = 25  # ids of five words fit 128 bits: 33 million words that are frequent

SHARDS = "shard bigint, lang string, words bigint, kinds bigint, numbers binary, vocabulary binary, counts binary"
SEGMENTS = "shard bigint, lang string, block bigint, vocabulary binary, numbers binary, counts binary"
WORDS = "shard bigint, numbers binary, ids binary, id int, lang string, word string, f bigint"
LEVEL = "shard bigint, numbers binary, starts binary, block bigint, filter binary"
COUNTED = "shard bigint, block bigint, flags binary, words array<int>, f bigint"


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    kinds["array<int>"] = pa.list_(pa.int32())
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


# --- compact columns -------------------------------------------------------------------------------


def squeeze(values: np.ndarray) -> bytes:
    """Non-negative integers, byte by byte: all lowest bytes first, then all next ones as far as any
    value has them. Small values cost little."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.compress(planes.tobytes(), 1)


def unsqueeze(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view("<u8").reshape(-1).astype(np.int64)


def squeeze_words(words: list[bytes]) -> bytes:
    return zstandard.compress(b"\n".join(words), 1)  # no word holds a line end


def unsqueeze_words(data: bytes) -> list[bytes]:
    return zstandard.decompress(data).split(b"\n")


# --- shards ----------------------------------------------------------------------------------------


def _parts(data: bytes, size: int):
    """``data`` in parts of about ``size`` bytes, cut between pieces only."""
    start = 0
    while len(data) - start > size:
        cut = data.rfind(b".", start, start + size)
        cut = cut if cut >= 0 else data.find(b".", start + size)
        if cut < 0:
            break
        yield data[start:cut]
        start = cut + 1
    yield data[start:] if start else data


def numbered_words(data: bytes) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Word numbers with 0 between pieces, the words by number from 1 on, the commonest first, and how
    often each occurs."""
    found: defaultdict[bytes, int] = defaultdict()
    found.default_factory = found.__len__
    found[b"."] = 0
    tokens = data.replace(b".", b" . ").split()
    numbers = np.fromiter(map(found.__getitem__, tokens), np.int32, len(tokens))
    counts = np.bincount(numbers, minlength=len(found))[1:]
    order = np.argsort(-counts, kind="stable")
    rank = np.zeros(len(found), np.int32)
    rank[order + 1] = np.arange(1, len(found), dtype=np.int32)
    words = list(found)[1:]
    return rank[numbers], [words[i] for i in order.tolist()], counts[order]


def word_shards(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """Rows of up to SHARD_BYTES of one language's texts: their words, numbered within the row."""

    def run(batches):
        task = TaskContext.get().partitionId() << 32
        held: defaultdict[str, list[bytes]] = defaultdict(list)
        sizes: defaultdict[str, int] = defaultdict(int)
        made = 0

        def flush(name):
            nonlocal made
            sizes.pop(name)
            for part in _parts(b".".join(held.pop(name)), SHARD_BYTES):
                numbers, words, counts = numbered_words(part)
                if not words:
                    continue
                row = {
                    "shard": task + made,
                    "lang": name,
                    "words": int(counts.sum()),
                    "kinds": len(words),
                    "numbers": squeeze(numbers),
                    "vocabulary": squeeze_words(words),
                    "counts": squeeze(counts),
                }
                made += 1
                yield pa.RecordBatch.from_pylist([row], schema=arrow_schema(SHARDS))

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = (value.as_py() or b"").lower().translate(TO_BREAKS)
                held[name].append(data)
                sizes[name] += len(data) + 1
                if sizes[name] >= SHARD_BYTES:
                    yield from flush(name)
                elif sum(sizes.values()) >= HELD_BYTES:
                    yield from flush(max(sizes, key=sizes.get))
        for name in list(held):
            yield from flush(name)

    chosen = docs.select(F.coalesce(quoted(lang).cast("string"), F.lit("und")), quoted(text).cast("string").cast("binary"))
    return chosen.mapInArrow(run, SHARDS)


def word_segments(shards: DataFrame, blocks: int) -> DataFrame:
    """Each shard's words, numbers and counts, dealt into ``blocks`` by the word's hash."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words, counts = unsqueeze_words(row["vocabulary"]), unsqueeze(row["counts"])
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
                dealt = (hashes % np.uint64(blocks)).astype(np.int64)
                order = np.argsort(dealt, kind="stable")
                found, starts = np.unique(dealt[order], return_index=True)
                rows = [
                    {
                        "shard": row["shard"],
                        "lang": row["lang"],
                        "block": block,
                        "vocabulary": squeeze_words([words[i] for i in chosen.tolist()]),
                        "numbers": squeeze(chosen + 1),
                        "counts": squeeze(counts[chosen]),
                    }
                    for block, chosen in zip(found.tolist(), np.split(order, starts[1:]), strict=True)
                ]
                for i in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_pylist(rows[i : i + 256], schema=arrow_schema(SEGMENTS))

    return shards.select("shard", "lang", "vocabulary", "counts").mapInArrow(run, SEGMENTS)


def merged_words(segments: DataFrame, blocks: int, least: int) -> DataFrame:
    """Rows (id, lang, word, f) of words found ``least`` times in a language, and for each shard and
    block rows (shard, numbers, ids): which of its words they are. Ids are dealt from 1 on, to the
    common words of a block first."""

    def run(key, table):
        block = key[0].as_py()
        rows = [(s, n, unsqueeze_words(v), unsqueeze(m), unsqueeze(c)) for s, n, v, m, c in zip(
            *(table[name].to_pylist() for name in ("shard", "lang", "vocabulary", "numbers", "counts")), strict=True
        )]
        totals: defaultdict[str, Counter] = defaultdict(Counter)
        for _, lang, words, _, counts in rows:
            total = totals[lang]
            for word, count in zip(words, counts.tolist(), strict=True):
                total[word] += count
        often = [(-f, lang, word) for lang, total in totals.items() for word, f in total.items() if f >= least]
        often.sort()
        ids = {(lang, word): rank * blocks + block + 1 for rank, (_, lang, word) in enumerate(often)}
        out = [
            {"id": ids[lang, word], "lang": lang, "word": word.decode(), "f": -f} for f, lang, word in often
        ]
        for shard, lang, words, numbers, _ in rows:
            known = [ids.get((lang, word), 0) for word in words]
            known = np.array(known, np.int64)
            if known.any():
                held = known > 0
                out.append({"shard": shard, "numbers": squeeze(numbers[held]), "ids": squeeze(known[held])})
        return pa.Table.from_pylist(out, schema=arrow_schema(WORDS))

    chosen = segments.select("block", "shard", "lang", "vocabulary", "numbers", "counts")
    return chosen.groupBy("block").applyInArrow(run, WORDS)


# --- counting --------------------------------------------------------------------------------------


def key_space(size: int, bits: int, occurrences: int) -> KeySpace:
    """Keys of ``size`` ids of ``bits`` bits, in blocks of about BLOCK_ENTRIES occurrences at most."""
    total = size * bits
    left = -(-total // 2)
    blocks = max(0, (-(-occurrences // BLOCK_ENTRIES) - 1)).bit_length()
    return KeySpace(left, total - left, min(left, blocks))


def packed(numbers: np.ndarray, starts: np.ndarray, size: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the phrase at each start, first word highest, in two halves; for an odd number of
    words the one in the middle is split."""
    ids = [numbers[starts + i].astype(np.uint64) for i in range(size)]
    half, low = size // 2, bits // 2
    left, right = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    for word in ids[:half]:
        left = (left << np.uint64(bits)) | word
    if size % 2:
        left = (left << np.uint64(bits - low)) | (ids[half] >> np.uint64(low))
        right = ids[half] & np.uint64((1 << low) - 1)
    for word in ids[size - half :]:
        right = (right << np.uint64(bits)) | word
    return left, right


def unpacked(left: np.ndarray, right: np.ndarray, size: int, bits: int) -> np.ndarray:
    """Rows of ids."""
    half, low, mask = size // 2, bits // 2, np.uint64((1 << bits) - 1)
    ids = np.zeros((len(left), size), np.int32)
    for i in range(size - 1, size - half - 1, -1):
        ids[:, i] = right & mask
        right = right >> np.uint64(bits)
    if size % 2:
        high = left & np.uint64((1 << (bits - low)) - 1)
        ids[:, half] = (high << np.uint64(low)) | (right & np.uint64((1 << low) - 1))
        left = left >> np.uint64(bits - low)
    for i in range(half - 1, -1, -1):
        ids[:, i] = left & mask
        left = left >> np.uint64(bits)
    return ids


def _keys(space: KeySpace, numbers: np.ndarray, starts: np.ndarray, size: int, bits: int):
    return space.distinct(*space.permute(*packed(numbers, starts, size, bits)))


def _squeezed(numbers: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """What the phrases at ``starts`` cover, with one 0 wherever something was left out."""
    edge = np.zeros(len(numbers) + size + 1, np.int32)
    edge[starts] += 1
    edge[starts + size] -= 1
    covered = np.cumsum(edge)[: len(numbers)] > 0
    kept = covered.copy()
    kept[1:] |= covered[:-1]  # the place after a covered stretch becomes its 0
    place = np.cumsum(kept) - 1
    return np.where(covered, numbers, 0)[kept].astype(np.int32), place[starts]


def _level_rows(shard: int, numbers: np.ndarray, starts: np.ndarray, space: KeySpace, size: int, bits: int):
    """The shard's state for this length, and one filter for each block."""
    numbers, starts = _squeezed(numbers, starts, size)
    marks = np.zeros(len(numbers), bool)
    marks[starts] = True
    rows = [{"shard": shard, "numbers": squeeze(numbers), "starts": np.packbits(marks).tobytes()}]
    left, right, place = _keys(space, numbers, starts, size, bits)
    counts = np.bincount(place, minlength=len(left))
    blocks, edges = space.edges(left)
    for block, a, b in zip(blocks.tolist(), edges, edges[1:], strict=False):
        data = quotient_filter.encode(space, left[a:b], right[a:b], counts[a:b])
        rows.append({"shard": shard, "block": block, "filter": data})
    return pa.Table.from_pylist(rows, schema=_LEVEL)


_LEVEL = arrow_schema(LEVEL)


def first_level(shards: DataFrame, known: DataFrame, space: KeySpace, bits: int) -> DataFrame:
    """Pairs of frequent words, from shards and their words' ids."""

    def run(key, shard, ids):
        if not shard.num_rows:
            return _LEVEL.empty_table()
        numbers = unsqueeze(shard["numbers"][0].as_py())
        table = np.zeros(int(numbers.max(initial=0)) + 1, np.int32)
        for known, given in zip(ids["numbers"].to_pylist(), ids["ids"].to_pylist(), strict=True):
            table[unsqueeze(known)] = unsqueeze(given)
        numbers = table[numbers]
        starts = np.flatnonzero((numbers[:-1] > 0) & (numbers[1:] > 0))
        return _level_rows(key[0].as_py(), numbers, starts, space, 2, bits)

    left = shards.select("shard", "numbers").groupBy("shard")
    return left.cogroup(known.groupBy("shard")).applyInArrow(run, LEVEL)


def next_level(level: DataFrame, counted: DataFrame, before: KeySpace, space: KeySpace, size: int, bits: int) -> DataFrame:
    """Phrases of ``size`` words, from the state of those of one word less and their flags."""

    def run(key, state, flags):
        if not state.num_rows:
            return _LEVEL.empty_table()
        numbers = unsqueeze(state["numbers"][0].as_py())
        marks = np.unpackbits(np.frombuffer(state["starts"][0].as_py(), np.uint8), count=len(numbers))
        starts = np.flatnonzero(marks)
        left, _, place = _keys(before, numbers, starts, size - 1, bits)
        often = np.zeros(len(left), bool)
        blocks, edges = before.edges(left)
        for block, data in zip(flags["block"].to_pylist(), flags["flags"].to_pylist(), strict=True):
            i = int(np.searchsorted(blocks, block))
            a, b = edges[i], edges[i + 1]
            often[a:b] = np.unpackbits(np.frombuffer(data, np.uint8), count=b - a)
        alive = np.zeros(len(numbers) + 1, bool)
        alive[starts] = often[place]
        starts = np.flatnonzero(alive[:-1] & alive[1:])
        return _level_rows(key[0].as_py(), numbers, starts, space, size, bits)

    states = level.where(F.col("numbers").isNotNull()).select("shard", "numbers", "starts")
    flags = counted.where(F.col("flags").isNotNull()).select("shard", "block", "flags")
    return states.groupBy("shard").cogroup(flags.groupBy("shard")).applyInArrow(run, LEVEL)


def counted_level(level: DataFrame, space: KeySpace, size: int, bits: int, least: int) -> DataFrame:
    """The merged filters: a row (words, f) for each frequent phrase, and for each shard and block
    with any the flags of the shard's keys."""

    def run(key, table):
        block, shards = key[0].as_py(), table["shard"].to_pylist()
        filters = [quotient_filter.decode(space, block, data.as_py()) for data in table["filter"]]
        left, right, f, places = quotient_filter.merge(space, filters)
        often = f >= least
        ids = unpacked(*space.restore(left[often], right[often]), size, bits)
        flags = [often[place] for place in places]
        rows = [(s, np.packbits(x).tobytes()) for s, x in zip(shards, flags, strict=True) if x.any()]
        n, m = len(ids), len(rows)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, size * n + 1, size), pa.int32()), pa.array(ids.reshape(-1)))
        return pa.table(
            {
                "shard": pa.array([None] * n + [s for s, _ in rows], pa.int64()),
                "block": pa.array([None] * n + [block] * m, pa.int64()),
                "flags": pa.array([None] * n + [x for _, x in rows], pa.binary()),
                "words": pa.concat_arrays([lists, pa.nulls(m, pa.list_(pa.int32()))]),
                "f": pa.array([*f[often].tolist(), *[None] * m], pa.int64()),
            }
        )

    filters = level.where(F.col("filter").isNotNull()).select("shard", "block", "filter")
    return filters.groupBy("block").applyInArrow(run, COUNTED)


def frequent_phrases(docs: DataFrame, *, lang: str, text: str, least: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """The words (id, lang, word, f, n), and the phrases (words, f) of 1 to ``longest`` ids that occur
    ``least`` times or more."""
    shards = stored(word_shards(docs, lang, text), "phrase-shards")
    kinds = shards.agg(F.sum("kinds")).first()[0] or 0
    blocks = -(-kinds // BLOCK_WORDS) or 1
    merged = stored(merged_words(word_segments(shards, blocks), blocks, least), "phrase-words")
    totals = shards.groupBy("lang").agg(F.sum("words").alias("n"))
    words = merged.where(F.col("id").isNotNull()).select("id", "lang", "word", "f").join(totals, "lang")
    words = stored(words, "phrase-word-ids")
    known = merged.where(F.col("ids").isNotNull()).select("shard", "numbers", "ids")
    highest, total = words.agg(F.max("id"), F.sum("f")).first()
    bits = max(1, int(highest or 0).bit_length())
    if bits > WORD_BITS:
        raise ValueError(f"more than 2**{WORD_BITS} frequent words: raise the least count")
    found = [words.select(F.array("id").alias("words"), "f")]
    space, level, counted = None, None, None
    for size in range(2, longest + 1):
        before, space = space, key_space(size, bits, int(total or 0))
        if size == 2:
            made = first_level(shards, known, space, bits)
        else:
            made = next_level(level, counted, before, space, size, bits)
        level = stored(made, f"phrases-{size}")
        counted = stored(counted_level(level, space, size, bits, least), f"phrases-{size}-counted")
        often = counted.where(F.col("words").isNotNull()).select("words", "f")
        total = often.agg(F.sum("f")).first()[0]
        found.append(often)
    return words, reduce(DataFrame.unionByName, found)


# --- scores ----------------------------------------------------------------------------------------


def collocations(
    docs: DataFrame, *, lang: str = "lang", text: str = "text", least: int = 100, longest: int = 5, top: int = 2000
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), split into pieces at punctuation and line ends and into words at
    blanks. A phrase of 2 to ``longest`` words that occurs a >= ``least`` times is scored by its
    weakest cut into parts that occur l and r times among n words: floor(1000 a n / (l r)), the
    first cut of equals. Phrases inside a longer one that occurs as often are left out: if any is
    as frequent, one longer by a single word is too, so that is all that is looked up.

    Null texts are empty, a null language is ``und``. Repeated rows count as often as they stand. Long
    texts are parted between pieces. Tables without frequent phrases give no rows. Ties in score go
    to the larger a, then to the phrase first in UTF-8 order.
    """
    chosen = docs.select(quoted(lang).alias("lang"), quoted(text).alias("text"))
    words, found = frequent_phrases(chosen, lang="lang", text="text", least=least, longest=longest)
    found = stored(found, "phrases-frequent")
    size = F.size("words")
    longer = found.where(size > 1).withColumnRenamed("f", "a")
    cuts = longer.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "words", "a", "k", F.slice("words", 1, F.col("k")).alias("head"), F.slice("words", F.col("k") + 1, size).alias("tail")
    )
    parts = found.select(F.col("words").alias("part"), F.col("f"))
    cuts = cuts.join(parts.select(F.col("part").alias("head"), F.col("f").alias("l")), "head")
    cuts = cuts.join(parts.select(F.col("part").alias("tail"), F.col("f").alias("r")), "tail")
    spelled = (
        longer.select("words", F.posexplode("words").alias("at", "id"))
        .join(words.select("id", "lang", "word", "n"), "id")
        .groupBy("words")
        .agg(
            F.max("lang").alias("lang"),
            F.max("n").alias("n"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase"),
        )
    )

    def whole(name):
        return F.col(name).cast("decimal(18,0)")

    score = F.call_function("div", whole("a") * whole("n") * F.lit(1000).cast("decimal(4,0)"), whole("l") * whole("r"))
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    scored = cuts.join(spelled, "words").groupBy("words", "lang", "phrase", "a", "n").agg(lowest.alias("cut"))
    covering = longer.where(size > 2).withColumn(
        "words", F.explode(F.array(F.slice("words", 1, size - 1), F.slice("words", 2, size)))
    )
    covered = covering.groupBy("words").agg(F.max("a").alias("longest"))
    kept = scored.join(covered, "words", "left").where(F.col("longest").isNull() | (F.col("longest") < F.col("a")))
    best = W.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
