"""Operator 7: pack tokenised documents into sequences by minimum bin slack.

Tokens are counted where the text is read; documents longer than a sequence are cut into full
pieces and a rest. Only the histogram of piece lengths, at most one count for each length, goes to
the driver. There windows are filled one after the other: the longest remaining length opens the
window, a bitset holds which sums the remaining lengths can reach, and the one closest to capacity
is traced back to a multiset of lengths. That filling is repeated while its lengths last, so there
are no more fillings than lengths. Pieces then find their places by their rank among equal lengths.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlark.llm.columns import fresh, quoted
from ledgerlark.sources.scratch import stored

HELD = 64_000_000  # bytes of each of a worker's two tables
CHUNK = 2_000_000  # characters worked on at a time, or one longer text
LONG = 200  # characters: longer stretches and words are not kept
#: Texts of these characters alone are split at white space, and each stretch is looked up; the
#: tokenizer's own normal form changes nothing in them but the case. Others go to it whole.
PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7eÀ-ÖØ-öø-ÿ¡¿«»°§·–—‘’“”…€]*")
PLAIN_CHARACTERS = [c for c in map(chr, range(0x2100)) if PLAIN.fullmatch(c)]
#: The tokenizer's own pattern for words, over those characters in lower case.
WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")
PIECE_ROWS = 10_000


class Known(dict):
    """What a worker has worked out, by text, up to ``limit`` bytes; beyond it the half that came
    first goes. Texts of more than ``LONG`` characters are never kept; with ``twice``, only those met
    before are, as most occur once."""

    EACH = 200  # bytes of an entry besides its characters and ids

    def __init__(self, work_out: Callable[[str], bytes], limit: int, twice: bool):
        self.work_out, self.limit, self.held = work_out, limit, 0
        self.met: set[int] | None = set() if twice else None

    def __missing__(self, text: str) -> bytes:
        ids = self.work_out(text)
        if len(text) > LONG:
            return ids
        if self.met is not None:
            key = hash(text)
            if key not in self.met:
                if len(self.met) >= self.limit // 100:
                    self.met.clear()
                self.met.add(key)
                return ids
        self.held += 2 * len(text) + len(ids) + self.EACH
        if self.held > self.limit:
            kept = list(islice(self.items(), len(self) // 2, None))
            self.clear()
            self.update(kept)
            self.held = sum(2 * len(t) + len(i) + self.EACH for t, i in kept)
        self[text] = ids
        return ids


class WordTokenizer:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, equal to the library's own.

    The tokenizer parts texts at white space and into words before anything else, so the ids of a
    stretch without white space do not depend on its neighbours, nor do those of a word: the model
    alone gives them, from the word's bytes as the tokenizer spells them. Tables of bounded size keep
    words, and stretches met twice.
    """

    def __init__(self, path: str, held: int = HELD):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {ord(c): spell(c)[0][0] for c in PLAIN_CHARACTERS if not c.isspace()}
        self.model = self.whole.model
        self.words = Known(self._word, held, twice=False)
        self.stretches = Known(self._stretch, held, twice=True)
        probe = "".join(PLAIN_CHARACTERS) + " it's a b1 über-groß 'll don't 12.50€ " + "probe" * 20
        if next(self.encode([probe])) != self._ids(probe):
            raise ValueError("the tokenizer works in a way that is not built here")

    def _ids(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        tokens = self.model.tokenize(word.translate(self.spelling))
        return array("I", [t.id for t in tokens]).tobytes()

    def _stretch(self, stretch: str) -> bytes:
        if stretch.isalpha():  # one word
            return self.words[stretch]
        return b"".join(map(self.words.__getitem__, WORD.findall(stretch)))

    def _plain(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of texts of plain characters: each different stretch is looked up once, and its ids
        are laid out wherever it stands."""
        lists = pc.ascii_split_whitespace(pa.array([t.lower() for t in texts], pa.large_string()))
        stretches = lists.values.dictionary_encode()
        codes = stretches.indices.to_numpy()
        found = list(map(self.stretches.__getitem__, stretches.dictionary.to_pylist()))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), "<u4")
        starts = np.cumsum(sizes) - sizes
        laid = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(laid)])
        places = np.repeat(starts[codes] - ends[:-1], laid) + np.arange(ends[-1])
        data = ids[places].tobytes()
        cuts = (4 * ends[lists.offsets.to_numpy()]).tolist()
        return (data[a:b] for a, b in zip(cuts, cuts[1:]))

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, in order."""
        texts = iter(texts)
        while True:
            held, size = [], 0
            for text in texts:
                held.append(text)
                size += len(text)
                if size >= CHUNK:
                    break
            if not held:
                return
            plain = [bool(PLAIN.fullmatch(t)) and not any(s in t for s in self.special) for t in held]
            done = self._plain([t for t, is_plain in zip(held, plain, strict=True) if is_plain])
            for text, is_plain in zip(held, plain, strict=True):
                yield next(done) if is_plain else self._ids(text)


_loaded: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker, kept from task to task."""
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    *,
    capacity: int = 4096,
    end_id: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: doc_id, start, length, ids_crc32, doc_tokens [, ids].

    A document's ids are those of its whole text and ``end_id``; a null or empty text has that
    one alone. Rows are independent: repeated rows and ids, or null ids, give their own pieces.
    ``tokenizer`` is the path of the tokenizer file on every machine.
    """
    kind = docs.schema[doc_id].dataType
    fields = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    ddl = f"doc_id {kind.simpleString()}, {fields}" + (", ids array<int>" if with_ids else "")
    ending = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode: Callable = word_tokenizer(tokenizer).encode
        for batch in batches:
            at, start, length, crc, total, ids = [], [], [], [], [], []
            texts = (value.as_py() or "" for value in batch.column(1))
            for i, data in enumerate(encode(texts)):
                data += ending
                n = len(data) // 4
                for begin in range(0, n, capacity):
                    part = data[4 * begin : 4 * (begin + capacity)]
                    at.append(i)
                    start.append(begin)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                    if with_ids:
                        ids.append(np.frombuffer(part, np.int32))
            columns = [batch.column(0).take(pa.array(at, pa.int64()))]
            columns += [pa.array(c, pa.int64()) for c in (start, length, crc, total)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text")).mapInArrow(run, ddl)


# --- filling ---------------------------------------------------------------------------------------


def padding(filled: int, capacity: int) -> int:
    """A sequence is padded to capacity, except where its length is a power of two."""
    return 0 if filled & (filled - 1) == 0 else capacity - filled


def fill_window(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of remaining lengths, the longest one included, that fills a window closest.

    Bit s of ``reach`` says that some of the lengths tried so far add up to s. Lengths are tried
    from the longest down, as many copies as there are, in doubling lots; every stage is kept, so
    that a sum is traced back to its lots. The search ends at the first full window. If none is
    full, a sum that needs no padding is taken, else the one with the least.
    """
    longest = max(counts)
    room = capacity - longest
    reach, stages = 1, []
    left = dict(counts)
    left[longest] -= 1
    limit = (1 << (room + 1)) - 1
    for length in sorted((n for n, c in left.items() if c and n <= room), reverse=True):
        copies, lot = min(left[length], room // length), 1
        while copies > 0:
            lot = min(lot, copies)
            stages.append((reach, length, lot))
            reach |= (reach << (length * lot)) & limit
            copies -= lot
            lot *= 2
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    sums = (s for s in range(room, -1, -1) if reach >> s & 1)
    best = room if reach >> room & 1 else min(sums, key=lambda s: (padding(longest + s, capacity), -s))
    chosen = {longest: 1}
    for before, length, lot in reversed(stages):
        if not before >> best & 1:  # this lot was needed for the sum
            best -= length * lot
            chosen[length] = chosen.get(length, 0) + lot
    return chosen


def fillings(counts: dict[int, int], capacity: int) -> Iterator[tuple[dict[int, int], int]]:
    """(multiset, repetitions) until every length is used up; each uses up one length at least."""
    counts = {n: c for n, c in counts.items() if c > 0}
    while counts:
        chosen = fill_window(counts, capacity)
        times = min(counts[n] // need for n, need in chosen.items())
        for n, need in chosen.items():
            counts[n] -= need * times
            if not counts[n]:
                del counts[n]
        yield chosen, times


PLAN = "length bigint, low bigint, high bigint, need bigint, first_sequence bigint, base bigint"


def filling_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, ...]]:
    """Which ranks of a length go where: at most ``capacity`` fillings of at most
    sqrt(2 * capacity) different lengths, however many pieces there are."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for chosen, times in fillings(counts, capacity):
        base = 0
        for length, need in sorted(chosen.items(), reverse=True):
            low = used.get(length, 0)
            used[length] = low + need * times
            rows.append((length, low, used[length], need, sequence, base))
            base += length * need
        sequence += times
    return rows


def pack(pieces: DataFrame, *, capacity: int = 4096, order: tuple[str, ...] = ("doc_id", "start", "ids_crc32")) -> DataFrame:
    """Every piece (column ``length``, 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    ``pieces`` should be a stored table, as it is read twice; its other columns stay, whatever their
    names. Lengths outside 1 to ``capacity`` raise, and an empty table gives an empty one. Equal rows
    are interchangeable: they are counted first, take as many places, and then stand apart again, so
    neither a length nor a row that a third of all pieces share comes to one task. A length is ranked
    in buckets of about ``PIECE_ROWS`` rows, whose offsets come from their counts.
    """
    spark = pieces.sparkSession
    counted = pieces.groupBy("length").count().collect()  # a row for each length: bounded by capacity
    counts = {row["length"]: row["count"] for row in counted}
    if any(n is None or not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths must be 1 to {capacity}")
    names = ("low", "high", "need", "first_sequence", "base", "bucket", "copies", "earlier", "within", "place", "digest")
    low, high, need, first, base, bucket, copies, earlier, within, place, digest = (fresh(pieces, n) for n in names)
    plan = spark.createDataFrame(filling_plan(counts, capacity), PLAN)
    plan = plan.toDF("length", low, high, need, first, base)
    buckets = 1 + sum(counts.values()) // PIECE_ROWS
    distinct = pieces.groupBy(*map(quoted, pieces.columns)).agg(F.count(F.lit(1)).alias(copies))
    dealt = distinct.withColumn(digest, F.xxhash64(*map(quoted, pieces.columns)))
    dealt = dealt.withColumn(bucket, F.pmod(quoted(digest), F.lit(buckets)))
    sizes = dealt.groupBy("length", bucket).agg(F.sum(copies).alias(copies))
    before = W.partitionBy("length").orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("length", bucket, F.coalesce(F.sum(copies).over(before), F.lit(0)).alias(earlier))
    ordered = W.partitionBy("length", bucket).orderBy(*order, digest).rowsBetween(W.unboundedPreceding, -1)
    start = F.col(earlier) + F.col(within)
    ranked = (
        dealt.withColumn(within, F.coalesce(F.sum(copies).over(ordered), F.lit(0)))
        .join(offsets, ["length", bucket])
        .withColumn(place, F.explode(F.sequence(start, start + F.col(copies) - 1)))
    )
    placed = ranked.join(F.broadcast(plan), "length").where((F.col(place) >= F.col(low)) & (F.col(place) < F.col(high)))
    nth = F.col(place) - F.col(low)
    return placed.select(
        *map(quoted, pieces.columns),
        (F.col(first) + F.call_function("div", nth, F.col(need))).cast("bigint").alias("sequence_id"),
        (F.col(base) + F.pmod(nth, F.col(need)) * F.col("length")).cast("bigint").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, *, capacity: int = 4096, **options) -> DataFrame:
    """Tokenise, store the pieces, and place them. An empty table gives no pieces."""
    pieces = stored(token_pieces(docs, tokenizer, capacity=capacity, **options), "token-pieces")
    return pack(pieces, capacity=capacity)
