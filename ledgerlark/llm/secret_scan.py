"""Operator 2: secret scans over a blob ledger, as DataFrame operations only.

Every version of every path is addressed by the SHA-256 of its text. The ledger has a row for
each scan of a blob: which rule versions ran and what they found. A run scans only the pairs of
blob and rule version that no ledger row covers, each blob once however many paths hold it, and
joins the findings back to all paths.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlark.llm.columns import fresh, quoted
from ledgerlark.sources.scratch import stored


@dataclass(frozen=True)
class SecretRule:
    """A pattern. Its matches are found from the left without overlap; then those are dropped
    whose group ``group`` has fewer than ``least`` characters. Raise ``version`` on any change."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(map(_either_case, ("password", "passwd", "secret", "token"))) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
#: The three base patterns of the contract, in its order. A run of hex digits or the
#: first AKIA of a run takes the whole run, so their least lengths can stand in the pattern.
BASE_RULES = (
    SecretRule("assign", rf"({_KEYS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", group=2, least=6),
    SecretRule("access", "AKIA[A-Z0-9]{16,}"),
    SecretRule("hex", "[0-9a-f]{24,}"),
)
#: Token formats that services publish.
MORE_RULES = (
    SecretRule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    SecretRule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("slack", "xox[abprs]-[A-Za-z0-9-]{15,}"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+"),
)
RULES = BASE_RULES + MORE_RULES
LEDGER = "blob binary, scanned array<string>, spans array<struct<start: bigint, rank: int, kind: string, end: bigint>>"


def _at_least(n: int):
    return lambda match: F.length(match) >= n


def _of_kind(*kinds: str):
    return lambda span: span["kind"].isin(*kinds)


def blob_of(text: Column) -> Column:
    """The content address: SHA-256 of the text's UTF-8, null as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def scan_unseen(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    rules: Sequence[SecretRule] = RULES,
    *,
    text: str = "text",
) -> DataFrame:
    """New ledger rows for the blobs and rule versions of ``versions`` that ``ledger`` lacks.

    Append them to the ledger. Columns as in ``LEDGER``: the blob, the rules that ran (kind and
    version), and the spans they found, ordered by start, then by the rules' order; start and end
    count code points, the end is exclusive. A blob without findings has an empty array, so that
    it is not scanned again. Nothing unseen: no rows.

    Copies meet in one row before anything is scanned; with partial aggregation a blob with a third
    of all rows sends one row per task. The only rows grouped are those of one text.
    """
    keys = F.array(*(F.lit(rule.key) for rule in rules))
    blobs = (
        versions.select(blob_of(quoted(text)).alias("blob"), F.coalesce(quoted(text), F.lit("")).alias("text"))
        .groupBy("blob")
        .agg(F.first("text").alias("text"))
    )
    if ledger is None:
        blobs = blobs.withColumn("todo", keys)
    else:
        seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("scanned"))).alias("seen"))
        blobs = (
            blobs.join(seen, "blob", "left")
            .select("blob", "text", F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo"))
            .where(F.size("todo") > 0)
        )
    found = [
        F.when(
            F.array_contains("todo", rule.key) & F.col("text").rlike(rule.regex),
            F.struct(
                F.lit(rank).alias("rank"),
                F.lit(rule.kind).alias("kind"),
                F.arrays_zip(
                    F.transform(F.split("text", rule.regex, -1), F.length).alias("gap"),
                    F.transform(
                        F.regexp_extract_all("text", F.lit(rule.regex), F.lit(0)), F.length
                    ).alias("size"),
                    F.transform(
                        F.regexp_extract_all("text", F.lit(rule.regex), F.lit(rule.group)),
                        _at_least(rule.least),
                    ).alias("good"),
                ).alias("parts"),
            ),
        )
        for rank, rule in enumerate(rules)
    ]
    scanned = blobs.select("blob", "todo", F.array_compact(F.array(*found)).alias("hits"))
    hits = scanned.select("blob", "todo", F.explode_outer("hits").alias("hit"))
    parts = hits.select("blob", "todo", "hit.rank", "hit.kind", F.posexplode_outer("hit.parts").alias("at", "part"))
    # Gaps and matches alternate, so running sums give the places.
    before = W.partitionBy("blob", "rank").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    gap, size = F.col("part.gap").cast("bigint"), F.coalesce(F.col("part.size"), F.lit(0)).cast("bigint")
    placed = parts.select(
        "blob", "todo", "rank", "kind", F.col("part.good").alias("good"), size.alias("size"),
        F.sum(gap + size).over(before).alias("end"),
    )
    span = F.struct((F.col("end") - F.col("size")).alias("start"), F.col("rank"), F.col("kind"), F.col("end"))
    return placed.groupBy("blob").agg(
        F.first("todo").alias("scanned"),
        F.array_sort(F.collect_list(F.when(F.col("good"), span))).alias("spans"),
    )


def findings(
    versions: DataFrame,
    ledger: DataFrame,
    rules: Sequence[SecretRule] = RULES,
    *,
    text: str = "text",
    one_row_a_blob: bool = False,
) -> DataFrame:
    """Every row of ``versions`` with a ``spans`` column: what the ledger knows of its text.

    Only findings of the given rule versions count. A text for which the ledger has none of them
    has null spans. A ledger of one scan has one row a blob; saying so spares a grouping, and lets
    adaptive execution split a blob that a third of all rows hold. An existing ``spans`` column
    stays; the new one then gets underscores added.
    """
    spans, key, own = (fresh(versions, name) for name in ("spans", "ledger_blob", "own_blob"))
    ran = {rule.kind: F.array_contains("scanned", rule.key) for rule in rules}
    counts = reduce(Column.__or__, ran.values(), F.lit(False))

    def current(span):
        return reduce(Column.__or__, ((span["kind"] == kind) & is_in for kind, is_in in ran.items()), F.lit(False))

    known = ledger.where(counts).select("blob", F.filter("spans", current).alias("spans"))
    if not one_row_a_blob:
        known = known.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    known = known.select(F.col("blob").alias(key), F.col("spans").alias(spans))
    # The address as a column: where the text itself is not asked for, it is not shuffled.
    addressed = versions.withColumn(own, blob_of(quoted(text)))
    return addressed.join(known, quoted(own) == quoted(key), "left").drop(own, key)


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with each stretch that spans cover, overlapping ones together, as one ``mark``."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(done, span):
        gap = F.substring(text, (done["at"] + 1).cast("int"), F.greatest(span["start"] - done["at"], F.lit(0)).cast("int"))
        new = (span["start"] >= done["at"]) | (done["at"] == 0)
        return F.struct(
            F.when(new, F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"]).alias("out"),
            F.greatest(done["at"], span["end"]).alias("at"),
        )

    def rest(done):
        return F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.lit(2147483647)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)


def digest_columns(spans: Column) -> dict[str, Column]:
    """Counts and digests of the base findings, and all spans as text."""
    base = F.filter(spans, _of_kind(*(rule.kind for rule in BASE_RULES)))

    def joined(found):
        return F.array_join(
            F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        )

    counts = {
        f"n_{rule.kind}": F.size(F.filter(spans, _of_kind(rule.kind))).cast("bigint")
        for rule in BASE_RULES
    }
    return counts | {"base_sha256": F.sha2(joined(base), 256), "spans": joined(spans)}


def scan_secrets(versions: DataFrame, ledger: DataFrame | None = None, *, text: str = "text") -> DataFrame:
    """Scan what is unseen, store the new ledger rows, and return ``versions`` with their spans."""
    new = stored(scan_unseen(versions, ledger, text=text), "secret-ledger")
    grown = new if ledger is None else ledger.unionByName(new)
    return findings(versions, grown, text=text, one_row_a_blob=ledger is None)
