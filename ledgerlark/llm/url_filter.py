"""Operator 1: URL filters, as DataFrame operations only.

Each rule is a pattern. It is indexed under one word of its literal text: the one that fewest of
the table's URLs hold. The words of a URL fetch the rules filed under them, and only those rules
run their regular expression on it. Rules without a usable word are filed under the empty word,
which every URL has.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm.columns import fresh, quoted
from ledgerlark.sources.scratch import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = re.compile(r"[a-z0-9]+")
#: What ``^`` stands for in a pattern: a character that parts words, or the end.
SEPARATOR = r"(?:[^a-zA-Z0-9_.%-]|$)"

RULES_SCHEMA = (
    "rule string, verdict string, site boolean, regex string, words array<string>, "
    "host_chars int, chars int"
)


@dataclass(frozen=True)
class UrlRule:
    """One rule. With ``site``, ``text`` is a host and a path beginning (``example.net/en/``): it
    fits that host and its subdomains where the path starts so. Otherwise ``text`` is a pattern
    over the lower-cased URL: ``*`` any characters, ``^`` a separator, ``||`` at the beginning a
    host or subdomain start, ``|`` at either end the URL's end; else it may lie anywhere."""

    text: str
    verdict: str
    site: bool = False

    def row(self) -> tuple:
        host = self.text.partition("/")[0] if self.site else ""
        return (
            self.text, self.verdict, self.site, self._regex(), self._words(), len(host), len(self.text),
        )

    def _regex(self) -> str:
        if self.site:
            return r"(?s)^(?:[^/]*\.)?" + _literal(self.text)
        text, before, after = self.text.lower(), "", ""
        if text.startswith("||"):
            text, before = text[2:], r"^[^/?#]*://(?:[^/?#]*\.)?"
        elif text.startswith("|"):
            text, before = text[1:], "^"
        if text.endswith("|"):
            text, after = text[:-1], r"\z"
        parts = [{"*": ".*", "^": SEPARATOR}.get(p) or _literal(p) for p in re.split(r"([*^])", text) if p]
        return "(?s)" + before + "".join(parts) + after

    def _words(self) -> list[str]:
        """Words that a fitting URL holds whole: both neighbours part words or are the end."""
        text = self.text.translate(str.maketrans(UPPER, LOWER)) if self.site else self.text.lower()
        # A site rule starts where a host label starts, and may end inside a word.
        closed_start, closed_end = self.site, False
        if not self.site:
            closed_start, closed_end = text.startswith("|"), text.endswith("|")
            text = text.strip("|")
        found = []
        for m in WORD.finditer(text):
            left = text[m.start() - 1] != "*" if m.start() else closed_start
            right = text[m.end()] != "*" if m.end() < len(text) else closed_end
            if left and right:
                found.append(m.group())
        return sorted(set(found))


def _literal(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9_/])", r"\\\1", text)


#: The host and path rules of the contract.
SITE_RULES = (
    UrlRule("net/", "block", site=True),
    UrlRule("example.net/en/", "allow", site=True),
    UrlRule("example.com/de/", "block", site=True),
    UrlRule("org/fr/", "allow", site=True),
)
#: Words of unwanted sites.
PATTERN_RULES = tuple(
    UrlRule(f"||{name}.", "block") for name in ("casino-win", "cheap-pills", "free-bets", "adult-x", "spam-farm")
) + (UrlRule("*/tracker/*", "block"), UrlRule("^popunder^", "block"))


def rules_table(spark: SparkSession, rules: Sequence[UrlRule]) -> DataFrame:
    """The rules as a table. The list is configuration, held by the caller, and one text of the plan."""
    fields = [part.split(" ", 1) for part in RULES_SCHEMA.split(", ")]
    kind = f"array<struct<{', '.join(f'{name}: {kind}' for name, kind in fields)}>>"
    rows = [dict(zip((name for name, _ in fields), rule.row(), strict=True)) for rule in rules]
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind)))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def url_words(url: Column) -> Column:
    """The distinct runs of a-z and 0-9 of the lower-cased URL, and the empty word."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(F.lower(url), "[^a-z0-9]+")))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[UrlRule] | DataFrame = SITE_RULES + PATTERN_RULES,
    *,
    url: str = "url",
    otherwise: str = "allow",
) -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` added.

    Of the site rules that fit, the longest wins (then the one with the longer host, then block
    before allow); it decides and is named in ``rule``. Where none fits, ``rule`` is
    null and the verdict is block if any fitting pattern blocks and none allows, else
    ``otherwise``. A null or empty URL has an empty host and path and gets ``otherwise`` unless a
    word-less pattern fits the empty text. Rows are kept one for one, repeated rows included. If
    ``pages`` already has one of the four columns, the new one gets underscores added.

    ``rules`` may be a table of many rules (columns as in ``RULES_SCHEMA``; see ``rules_table``). Each
    distinct URL is judged once, so a URL with a third of all rows is one small row there. The verdicts
    of fitting URLs are stored and then join back, so that adaptive execution can split the rows of such
    a URL, or send the verdicts to them. No step holds more than one URL's own rules together.
    """
    spark = pages.sparkSession
    address = F.coalesce(quoted(url), F.lit(""))
    table = rules if isinstance(rules, DataFrame) else rules_table(spark, rules)
    urls = pages.select(address.alias("u")).groupBy("u").agg(F.lit(1).alias("one")).select("u")
    words = urls.select("u", F.explode(url_words(F.col("u"))).alias("word"))

    # How many URLs hold each word of a rule; the rarest one files the rule.
    options = table.select("*", F.explode_outer("words").alias("word")).withColumn(
        "word", F.coalesce("word", F.lit(""))
    )
    asked = options.select("word").distinct()
    held = words.join(asked, "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("urls"))
    index = (
        options.join(held, "word", "left")
        .groupBy("rule", "verdict", "site", "regex", "host_chars", "chars")
        .agg(F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), F.col("word"))).alias("rarest"))
        .select("rule", "verdict", "site", "regex", "host_chars", "chars", F.col("rarest.word").alias("word"))
    )

    text = F.when(F.col("site"), F.concat(host_of(F.col("u")), path_of(F.col("u")))).otherwise(F.lower("u"))
    # An address without :// has no host, so no site rule may read one out of it.
    real = ~F.col("site") | F.col("u").contains("://")
    fits = words.join(index, "word").where(real & F.call_function("rlike", text, F.col("regex")))
    best = F.when(
        F.col("site"),
        F.struct(
            F.col("chars").alias("chars"),
            F.col("host_chars").alias("host_chars"),
            F.col("verdict").alias("verdict"),
            F.col("rule").alias("rule"),
        ),
    )
    judged = fits.groupBy("u").agg(
        F.max(best).alias("site_rule"),
        F.bool_or(~F.col("site") & (F.col("verdict") == "block")).alias("blocks"),
        F.bool_or(~F.col("site") & (F.col("verdict") == "allow")).alias("allows"),
    )
    judged = judged.select(
        F.col("u").alias(fresh(pages, "judged_url")),
        F.col("site_rule.rule").alias(fresh(pages, "rule")),
        F.coalesce(
            "site_rule.verdict",
            F.when(F.col("allows"), "allow").when(F.col("blocks"), "block"),
        ).alias(fresh(pages, "verdict")),
    )
    judged = stored(judged, "judged-urls")
    key, rule, verdict = judged.columns
    joined = pages.join(judged, address == judged[key], "left")
    return joined.select(
        *(pages[quoted_name(c)] for c in pages.columns),
        host_of(quoted(url)).alias(fresh(pages, "host")),
        path_of(quoted(url)).alias(fresh(pages, "path")),
        F.col(rule),
        F.coalesce(F.col(verdict), F.lit(otherwise)).alias(verdict),
    )


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
