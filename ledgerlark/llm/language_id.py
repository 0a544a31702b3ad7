"""Operator 5: language identification in two steps, first the family, then the language in it.

Both steps are one-versus-one linear support vector machines over hashed byte 3- and 4-grams of the
lower-cased text. A decision is a sum of weights over all places of the text, so prediction looks
weights up and adds them; nothing of the text is cut off.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ledgerlark.llm.columns import fresh, quoted

#: Families of common languages. A language that is not listed is its own family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "indic": ("hi", "bn", "mr", "ur", "pa"),
    "turkic": ("tr", "az", "kk", "uz"),
    "semitic": ("ar", "he"),
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}
UNDETERMINED = "und"
TABLE_BITS = 16  # for each gram length
PER_LANGUAGE = 800  # bound of the training sample: texts for each language
LANGUAGES = 200  # bound of the classes: the most frequent ones
CHUNK = 1 << 20
HASHES = 1 << 31  # the top 31 bits of a hash are compared with a threshold


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang, lang)


def grams(data: bytes) -> Iterator[np.ndarray]:
    """Table places of the 3- and 4-grams of a text's bytes, a bounded stretch at a time."""
    for start in range(0, max(1, len(data)), CHUNK):
        b = np.frombuffer(data[start : start + CHUNK + 3], np.uint8).astype(np.uint32)
        if start + CHUNK < len(data):
            three, four = CHUNK, CHUNK
        else:
            three, four = max(0, len(b) - 2), max(0, len(b) - 3)
        if not three:
            continue
        packed = b[:three] | b[1 : three + 1] << np.uint32(8) | b[2 : three + 2] << np.uint32(16)
        shift = np.uint32(32 - TABLE_BITS)
        yield (packed * np.uint32(2654435761)) >> shift
        if four:
            more = packed[:four] ^ (b[3 : four + 3] * np.uint32(0x9E3779B1))
            yield ((more * np.uint32(2246822519)) >> shift) + np.uint32(1 << TABLE_BITS)


def prepared(text: str) -> bytes:
    """Lower case, with an end mark on both sides so that short texts have grams too."""
    return b" " + text.lower().encode() + b" "


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def lettered(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


@dataclass(frozen=True)
class LanguageModel:
    """Decisions (winner if positive, winner if negative, among families or in a family)."""

    languages: tuple[str, ...]
    decisions: tuple[tuple[str, str, str], ...]  # (group, one, other); group "" holds the families
    weights: np.ndarray  # table places x decisions
    usual: np.ndarray  # mean size of each decision over its training texts

    def sums(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.decisions)), 0
        for places in grams(prepared(text)):
            total += self.weights[places].sum(axis=0, dtype=np.float64)
            n += len(places)
        return total / max(1, n)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and a score: 0 for ``und``, else 0.5 (a toss-up) to 1."""
        if not has_letter(text) or not self.languages:
            return UNDETERMINED, 0.0
        sums = self.sums(text)
        group, score = "", 1.0
        names = sorted({family_of(lang) for lang in self.languages})
        while True:
            won = dict.fromkeys(names, 0.0)
            sure = dict.fromkeys(names, 1.0)
            for value, size, (of, one, other) in zip(sums, self.usual, self.decisions, strict=True):
                if of == group:
                    winner = one if value >= 0 else other
                    won[winner] += 1
                    sure[winner] = min(sure[winner], 1 / (1 + float(np.exp(-4 * abs(value) / size))))
            best = min(names, key=lambda name: (-won[name], -sure[name], name))
            score = min(score, sure[best])
            if group:
                return best, score
            group, names = best, sorted(lang for lang in self.languages if family_of(lang) == best)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text is divisible by 5; a null id counts as the empty text, so it is."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _sparse(texts) -> Iterator[tuple[bytes, bytes]]:
    for text in texts:
        counts = np.zeros(2 << TABLE_BITS, np.float32)
        for places in grams(prepared(text)):
            counts += np.bincount(places, minlength=len(counts))
        at = np.flatnonzero(counts)
        values = counts[at] / (np.linalg.norm(counts[at]) or 1.0)
        yield at.astype(np.uint32).tobytes(), values.astype(np.float32).tobytes()


def train(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = PER_LANGUAGE,
    languages: int = LANGUAGES,
) -> LanguageModel:
    """Fit on at most ``per_language`` texts of each of at most ``languages`` languages.

    Only rows that are not held out, with a non-null language and a text with a letter, are looked
    at. The sample is the rows with the smallest hash of id and text, each once. Hashes are evenly
    spread, so a language's count of them gives a threshold that somewhat more than ``per_language``
    lie under; only those few meet by language. What reaches the driver is bounded by the sample and
    the table of grams, however long the texts are.
    """
    usable = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"), quoted(lang).alias("lang")).where(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    usable = usable.withColumn("h", F.xxhash64("doc_id", "text"))
    # Repeated rows share a hash and count once, here and in the sample, so they can't swell it.
    picked = (
        usable.select("lang", "h")
        .distinct()
        .groupBy("lang")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "lang")
        .limit(languages)
        .collect()
    )
    if not picked:
        return LanguageModel((), (), np.zeros((0, 0), np.float32), np.zeros(0))
    wanted = per_language + 6 * per_language**0.5  # the count under a threshold varies
    shares = ((row["lang"], min(1.0, wanted / row["n"])) for row in picked)
    most = F.create_map(*(F.lit(x) for lang, share in shares for x in (lang, int(share * HASHES))))

    def run(batches):
        for batch in batches:
            pairs = list(_sparse(t.as_py() for t in batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), pa.binary()) for c in zip(*pairs, strict=True))]
                if pairs
                else [batch.column(0), pa.array([], pa.binary()), pa.array([], pa.binary())],
                names=["lang", "at", "value"],
            )

    sample = (
        usable.where(F.shiftrightunsigned("h", 33) < F.element_at(most, F.col("lang")))
        .dropDuplicates(["lang", "h"])
        .withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy(F.shiftrightunsigned("h", 33), "h")))
        .where(F.col("n") <= per_language)
        .select("lang", "text")
        .mapInArrow(run, "lang string, at binary, value binary")
        .collect()
    )
    rows = sorted(
        (r["lang"], bytes(r["at"]), bytes(r["value"])) for r in sample
    )
    labels = [r[0] for r in rows]
    vectors = [(np.frombuffer(a, np.uint32), np.frombuffer(v, np.float32)) for _, a, v in rows]
    return fit(labels, vectors)


def fit(labels: Sequence[str], vectors: Sequence[tuple[np.ndarray, np.ndarray]]) -> LanguageModel:
    langs = tuple(sorted(set(labels)))
    families = sorted({family_of(lang) for lang in langs})
    decisions = [("", one, other) for one, other in combinations(families, 2)]
    for family in families:
        decisions += [(family, a, b) for a, b in combinations([x for x in langs if family_of(x) == family], 2)]
    weights = np.zeros((2 << TABLE_BITS, len(decisions)), np.float32)
    usual = np.ones(len(decisions))
    for d, (group, one, other) in enumerate(decisions):
        name = family_of if not group else str
        chosen = [(v, 1 if name(lang) == one else -1) for lang, v in zip(labels, vectors, strict=True) if name(lang) in (one, other)]
        w = linear_svm(chosen)
        weights[:, d] = w
        sizes = [abs(float(w[at] @ value)) / max(1e-9, float(value.sum())) for (at, value), _ in chosen]
        usual[d] = float(np.mean(sizes)) or 1.0
    return LanguageModel(langs, tuple(decisions), weights, usual)


def linear_svm(rows, cost: float = 1.0, rounds: int = 8) -> np.ndarray:
    """Squared-hinge support vector machine by dual coordinate descent, in a fixed random order."""
    w = np.zeros(2 << TABLE_BITS)
    alpha, ridge = np.zeros(len(rows)), 1 / (2 * cost)
    random = np.random.default_rng(0)
    # Balance: each side's rows together weigh the same.
    positive = sum(y > 0 for _, y in rows)
    share = {1: len(rows) / (2 * max(1, positive)), -1: len(rows) / (2 * max(1, len(rows) - positive))}
    for _ in range(rounds):
        for i in random.permutation(len(rows)):
            (at, value), y = rows[i]
            damp = ridge / share[y]
            slope = y * float(w[at] @ value) - 1 + damp * alpha[i]
            new = max(0.0, alpha[i] - slope / (float(value @ value) + damp))
            if new != alpha[i]:
                w[at] += (new - alpha[i]) * y * value
                alpha[i] = new
    return w


def identify(docs: DataFrame, model: LanguageModel, *, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``lang_pred`` and ``score`` (underscores added to taken names).

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned. Only the
    text decides. No shuffle; the model sent along is bounded by the number of languages.
    """
    names = [fresh(docs, "lang_pred"), fresh(docs, "score")]
    schema = T.StructType(
        [*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    )
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batches):
        predict = sent.value.predict
        for batch in batches:
            found = [predict(value.as_py()) for value in batch.column(place)]
            columns = [batch.column(i) for i in range(batch.num_columns)]
            columns.append(pa.array([f[0] for f in found], pa.string()))
            columns.append(pa.array([f[1] for f in found], pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)
