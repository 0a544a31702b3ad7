"""Operator 13: main texts of pages, by the template that the pages of a host share.

A page is a sequence of tokens: elements with their paths, and texts. How often a token occurs on each
page of its host is its occurrence vector; tokens with equal vectors form a class. Classes that occur
on enough pages and whose tokens keep their order on all of them are valid. Paths nest the valid
classes into the host's template, with a slot for text in each element. Texts in the class of the
element that holds the host's article, or of one around it, are part of the template; all others fill
slots, and the slots below that element are extracted. Vectors are never collected: they are compared by the digest
of their entries, combined where the pages are read.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.columns import fresh, quoted
from ledgerlark.llm.html_blocks import MAIN_TAGS, Element, Page, read_page
from ledgerlark.sources.scratch import stored

#: A class must occur on one page in so many: as each page has its tokens once, a template then has
#: at most this many times the tokens of an average page, whatever the host's size.
RARITY = 20
#: On fewer different pages than this, no text is taken for part of the template.
LEAST_PAGES = 5
#: If the texts found on all pages make up more of their articles than this, the pages are copies.
MOST_FIXED = 0.3
MENU, SHARE, ARTICLE = 0.6, 0.6, 0.3
HELD_HOSTS = 100

PATHS = "array<struct<path:string,n:int,first:int,chars:bigint>>"
TEXTS = "array<struct<path:string,text:bigint,n:int,first:int,chars:bigint>>"
TOKENS = f"host string, content bigint, paths {PATHS}, texts {TEXTS}"
TEMPLATE = "host string, main string, fixed array<bigint>, classes bigint"


def text_token(path: str, text: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{path}\0{text}".encode()) - (1 << 63)


def _is_menu(linked: int, text: str) -> bool:
    return linked > MENU * len(text)


def main_chars(page: Page) -> Counter:
    """For each path the characters below it that are neither marked as outside nor links."""
    chars: Counter[str] = Counter()
    for block in page.blocks:
        if block.element.is_outside() or _is_menu(block.linked, block.text):
            continue
        at: Element | None = block.element
        while at is not None:
            chars[at.path] += len(block.text)
            at = at.parent
    return chars


def _tag(path: str) -> str:
    return path.rsplit("/", 1)[-1].split(".", 1)[0]


def main_path(chars: dict[str, int]) -> str:
    """The path that holds the article: the element named so, if it holds enough of the text; else,
    from the top down, the one that holds most of the text of what it lies in."""
    named = [p for p in chars if _tag(p) == "article"] or [p for p in chars if _tag(p) in MAIN_TAGS]
    total = max(chars.values(), default=0)
    best = max(named, key=lambda p: (chars[p], -len(p), p), default=None)
    if best is not None and chars[best] >= ARTICLE * total:
        return best
    at = ""
    while True:
        below = [p for p in chars if p.startswith(at + "/") and "/" not in p[len(at) + 1 :]]
        most = max(below, key=lambda p: (chars[p], p), default=None)
        if most is None or _tag(most) in ("p", "li", "td", "h1", "h2", "h3") or chars[most] < SHARE * chars.get(at, 0):
            return at
        at = most


def within(path: str, main: str) -> bool:
    return path == main or path.startswith(main + "/")


def page_tokens(pages: DataFrame, url: str, html: str) -> DataFrame:
    """One row for each page: host, a digest of its HTML, its elements and its texts."""

    def run(batches):
        for batch in batches:
            rows = []
            for host, content, value in zip(*(batch.column(i) for i in range(3)), strict=True):
                page = read_page(value.as_py() or "")
                chars = main_chars(page)
                paths: dict[str, list] = {}
                texts: dict[tuple, list] = {}
                for first, element in enumerate(page.elements):
                    paths.setdefault(element.path, [element.path, 0, first])[1] += 1
                for first, block in enumerate(page.blocks):
                    key = (block.element.path, block.text)
                    texts.setdefault(key, [0, first])[0] += 1
                rows.append(
                    {
                        "host": host.as_py(),
                        "content": content.as_py(),
                        "paths": [{"path": p, "n": n, "first": i, "chars": chars[p]} for p, n, i in paths.values()],
                        "texts": [
                            {"path": p, "text": text_token(p, t), "n": n, "first": i, "chars": len(t)}
                            for (p, t), (n, i) in texts.items()
                        ],
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=_TOKENS)

    chosen = pages.select(host_of(url).alias("host"), F.xxhash64(quoted(html)).alias("content"), quoted(html).alias("html"))
    return chosen.mapInArrow(run, TOKENS)


_TOKENS = pa.schema(
    [
        ("host", pa.string()),
        ("content", pa.int64()),
        ("paths", pa.list_(pa.struct([("path", pa.string()), ("n", pa.int32()), ("first", pa.int32()), ("chars", pa.int64())]))),
        (
            "texts",
            pa.list_(
                pa.struct(
                    [("path", pa.string()), ("text", pa.int64()), ("n", pa.int32()), ("first", pa.int32()), ("chars", pa.int64())]
                )
            ),
        ),
    ]
)


def host_of(url: str):
    """What stands between ``://`` and the next ``/``, ``?`` or ``#``, in lower case; else empty."""
    return F.lower(F.coalesce(F.regexp_extract(quoted(url), "://([^/?#]*)", 1), F.lit("")))


def host_classes(tokens: DataFrame) -> DataFrame:
    """(host, pages, path, text, vector, support, chars) of tokens on enough of the host's pages.

    ``text`` is null for elements. Pages equal in content count once, so copies make no template.
    """
    every = tokens.select("host", "content", F.explode("paths").alias("t")).select(
        "host", "content", "t.path", F.lit(None).cast("bigint").alias("text"), "t.n", "t.chars"
    )
    every = every.unionByName(
        tokens.select("host", "content", F.explode("texts").alias("t")).select(
            "host", "content", "t.path", "t.text", "t.n", "t.chars"
        )
    )
    pages = tokens.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    found = every.groupBy("host", "path", "text").agg(
        F.count(F.lit(1)).alias("support"),
        F.bit_xor(F.xxhash64("content", "n")).alias("vector"),
        F.sum("chars").alias("chars"),
    )
    return found.join(pages, "host").where(F.col("support") * RARITY >= F.col("pages"))


def disordered(tokens: DataFrame, classes: DataFrame) -> DataFrame:
    """(host, vector) of classes whose tokens do not stand in the same order on all pages."""
    member = F.struct(F.coalesce("text", F.xxhash64("path")).alias("token"), "vector")
    held = stored(classes.groupBy("host").agg(F.collect_list(member).alias("members")), "html-classes")

    def run(batches):
        known: dict[str, dict[int, int]] = {}
        for batch in batches:
            out: dict[tuple, tuple[int, int]] = {}
            for host, tokens, members in zip(*(batch.column(i) for i in range(3)), strict=True):
                host = host.as_py()
                if host not in known:
                    if len(known) >= HELD_HOSTS:
                        known.clear()
                    known[host] = {m["token"]: m["vector"] for m in members.as_py()}
                orders: dict[int, xxhash.xxh3_64] = {}
                for token in tokens.as_py():
                    vector = known[host].get(token)
                    if vector is not None:
                        orders.setdefault(vector, xxhash.xxh3_64()).update(token.to_bytes(8, "little", signed=True))
                for vector, order in orders.items():
                    seen = order.intdigest() - (1 << 63)
                    low, high = out.get((host, vector), (seen, seen))
                    out[host, vector] = min(low, seen), max(high, seen)
            rows = [{"host": h, "vector": v, "low": a, "high": b} for (h, v), (a, b) in out.items()]
            yield pa.RecordBatch.from_pylist(rows, schema=_ORDERS)

    elements = F.transform("paths", lambda t: F.struct(t["first"].alias("at"), F.xxhash64(t["path"]).alias("token")))
    texts = F.transform("texts", lambda t: F.struct(t["first"].alias("at"), t["text"].alias("token")))

    def in_order(column):
        return F.transform(F.array_sort(column), lambda t: t["token"])

    # Elements and texts are numbered apart, so each kind's own order is compared.
    listed = tokens.select("host", F.concat(in_order(elements), in_order(texts)).alias("tokens"))
    orders = listed.join(held, "host").mapInArrow(run, "host string, vector bigint, low bigint, high bigint")
    spread = orders.groupBy("host", "vector").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return spread.where(F.col("low") < F.col("high")).select("host", "vector")


_ORDERS = pa.schema([("host", pa.string()), ("vector", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])


def _template(key, table):
    """A host's template from its valid classes: where its article is, and its fixed texts."""
    rows = table.to_pylist()
    chars = {r["path"]: r["chars"] for r in rows if r["text"] is None and r["chars"]}
    main = main_path({"": sum(c for p, c in chars.items() if p.count("/") == 1), **chars})
    around = {r["vector"] for r in rows if r["text"] is None and within(main, r["path"]) and r["support"] >= LEAST_PAGES}
    fixed = [r for r in rows if r["text"] is not None and r["vector"] in around]
    inside = sum(r["chars"] for r in fixed if within(r["path"], main))
    if inside > MOST_FIXED * chars.get(main, 0):
        fixed = [r for r in fixed if not within(r["path"], main)]
    row = {
        "host": key[0].as_py(),
        "main": main,
        "fixed": [r["text"] for r in fixed],
        "classes": len({r["vector"] for r in rows}),
    }
    return pa.Table.from_pylist([row], schema=_TEMPLATE)


_TEMPLATE = pa.schema(
    [("host", pa.string()), ("main", pa.string()), ("fixed", pa.list_(pa.int64())), ("classes", pa.int64())]
)


def host_templates(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, main, fixed, classes): the path of the article, tokens of fixed texts, classes."""
    tokens = stored(page_tokens(pages, url, html).dropDuplicates(["host", "content"]), "html-tokens")
    classes = stored(host_classes(tokens), "html-vectors")
    valid = classes.join(stored(disordered(tokens, classes), "html-disordered"), ["host", "vector"], "left_anti")
    # At most RARITY times an average page's tokens for each host.
    return valid.groupBy("host").applyInArrow(_template, TEMPLATE)


def main_text(source: str, main: str | None, fixed: set[int]) -> str:
    """The blocks of a page's slots below ``main``; a page without that path is judged by itself."""
    page = read_page(source)
    if main is None or (main and not any(within(e.path, main) for e in page.elements)):
        main = main_path(dict(main_chars(page)))
    kept = []
    for block in page.blocks:
        path = block.element.path
        if not within(path, main) or block.element.is_outside() or _is_menu(block.linked, block.text):
            continue
        if not fixed or text_token(path, block.text) not in fixed:
            kept.append(block.text)
    return "\n".join(kept)


def extract_main_text(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """Every page, with ``text`` and ``n_chars`` (with underscores where those names are taken).

    A page's text is that of its host's article slots: blocks in page order, one a line, references
    decoded, white space as one space. Null and empty pages have an empty text; pages of a null url
    or one without ``://`` are taken for one host. Repeated rows each get their row, and count once
    for the template. Long pages are read whole. An empty table gives an empty table.
    """
    templates = stored(host_templates(pages, url, html), "html-templates")
    names = [fresh(pages, name) for name in ("text", "n_chars", "html_host", "html_main", "html_fixed")]
    text, n_chars, host, main, fixed = names
    keyed = pages.withColumn(host, host_of(url))
    known = templates.select(F.col("host").alias(host), F.col("main").alias(main), F.col("fixed").alias(fixed))
    # Every host has a template unless none of its tokens is frequent; then pages speak for themselves.
    joined = keyed.join(known, host, "left").select(*map(quoted, pages.columns), main, fixed)
    kept = len(pages.columns)
    at = pages.columns.index(html)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema) + f", `{text}` string"

    def run(batches):
        for batch in batches:
            texts = []
            for source, main, fixed in zip(batch.column(at), batch.column(kept), batch.column(kept + 1), strict=True):
                texts.append(main_text(source.as_py() or "", main.as_py(), set(fixed.as_py() or ())))
            columns = [*batch.columns[:kept], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:kept], text])

    return joined.mapInArrow(run, ddl).withColumn(n_chars, F.length(quoted(text)).cast("bigint"))
