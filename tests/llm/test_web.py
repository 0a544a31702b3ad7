"""URL rules and archives."""

import hashlib
import base64
import re

import pytest

import __spark_entry__ as contract
from ledgerlark.llm import archives, queries
from ledgerlark.llm.oracle import ORACLE
from ledgerlark.llm.url_filter import SITE_RULES, UrlRule, judge_urls, rules_table
from ledgerlark.sources.scratch import stored
from tests.check_oracle import compare, tables

SCHEMA = "page_id bigint, url string, html string, rule int"


def pages(spark, *urls):
    return spark.createDataFrame([(n, u, "x", 1) for n, u in enumerate(urls)], SCHEMA)


def verdict(url, rules):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (m.group(1).lower(), m.group(2)) if m else ("", "")
    fit = []
    for r in rules:
        h, _, p = r.text.partition("/")
        if m and (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fit.append(r)
    best = max(fit, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text


def test_site_rules(spark):
    urls = [
        None, "", "no scheme", "http://a.net", "http://A.NET/x", "http://net/", "http://xnet/", "http://example.net/en/1",
        "http://www.example.net/en", "http://example.com/de/?q", "http://x.org/fr/a#b", "http://org/fr", "http://h?x://y.net/",
        "http://example.net/EN/", "http://u@a.net:80/", "mailto:net/", "http://" + "a" * 50_000 + ".net/", "http://a.net/\n/b",
    ]
    found = judge_urls(pages(spark, *urls, *urls), SITE_RULES).collect()
    assert len(found) == 2 * len(urls)
    for row in found:
        assert (row["host"], row["path"], row["rule_"]) == verdict(row["url"], SITE_RULES)


def test_patterns(spark):
    rules = [
        UrlRule("||bad-site.com^", "block"), UrlRule("/ads/*.gif|", "block"), UrlRule("*frag*", "block"),
        UrlRule("||good.org^", "allow"), UrlRule("|ftp://", "block"),
    ]
    urls = {
        "http://bad-site.com/": "block", "http://x.bad-site.com": "block", "http://notbad-site.com/": "allow",
        "http://h/ads/a/b.gif": "block", "http://h/ads/b.gif?x": "allow", "http://h/xFRAGx": "block",
        "http://good.org/frag": "allow", "ftp://h/": "block", "http://h/ftp://": "allow",
    }
    found = judge_urls(pages(spark, *urls), rules).collect()
    assert {r["url"]: r["verdict"] for r in found} == urls
    assert judge_urls(pages(spark), rules).count() == 0
    assert {r["verdict"] for r in judge_urls(pages(spark, *urls), []).collect()} == {"allow"}


@pytest.fixture
def split_eagerly(spark):
    """Adaptive execution takes even small partitions for skewed, and nothing is broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    saved = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_url_is_split(spark, split_eagerly):
    """A third of all rows with one URL, and a third without any."""
    urls = [f"http://h{n}.example.net/{n}" if n % 3 == 0 else "http://hot.net/" if n % 3 == 1 else None for n in range(30_000)]
    judged = judge_urls(pages(spark, *urls).repartition(8), SITE_RULES)
    rows = judged.collect()
    assert "SortMergeJoin(skew=true)" in judged._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == len(urls) and sum(r["verdict"] == "block" for r in rows) == 20_000


def test_very_many_rules(spark):
    rules = [UrlRule(f"||site{n}.com^", "block") for n in range(100_000)]
    urls = {"http://site77.com/": "block", "http://www.site99999.com": "block", "http://site100000.com/": "allow"}
    for given in (rules, stored(rules_table(spark, rules), "rules")):
        assert {r["url"]: r["verdict"] for r in judge_urls(pages(spark, *urls), given).collect()} == urls


def test_archives_round_trip(spark):
    table = spark.createDataFrame(
        [
            (1, "http://a b/\n", "same"), (2, None, "same"), (3, "http://c/", "same"), (4, "http://d/é", None), (5, "", ""),
            (6, "http://e/", "HTTP/1.1 200\r\n\r\nWARC/1.0\r\n" * 3), (7, "u", "é" * 2_000_000), (7, "u", "twice"),
            (None, "n", "alone"), (None, "n", "same"), (8, "v", "repeat"), (8, "v", "repeat"),
        ],
        "page_id bigint, url string, html string",
    )
    arcs = archives.write_arc(table)
    assert {r["version"] for r in arcs.collect()} == {1, 2}
    records = archives.read_arc(arcs).collect()
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    rows = table.collect()
    assert sorted((str(r["item"]), bytes(r["payload"])) for r in records) == sorted(
        (str(r["page_id"]), (r["html"] or "").encode()) for r in rows
    )
    kept = archives.read_warc(archives.arc_to_warc(arcs)).collect()
    ours = sorted((str(r["item"]), r["digest"], r["payload_bytes"], r["record_type"], str(r["refers_to_item"])) for r in kept)
    top = {}
    for r in rows:
        if r["page_id"] is not None:
            top[r["html"] or ""] = max(top.get(r["html"] or "", 0), r["page_id"])
    want = []
    for r in rows:
        text, best = r["html"] or "", top.get(r["html"] or "")
        alone = best is None or best == r["page_id"] or sum((x["html"] or "") == text for x in rows) == 1
        want.append((str(r["page_id"]), sha(text), len(text.encode()), "response" if alone else "revisit", "None" if alone else str(best)))
    assert ours == sorted(want)
    assert len({r["record_id"] for r in kept}) == len(kept)  # equal records too have their own
    names = {r["record_id"] for r in kept if r["record_type"] == "response"}
    assert all(r["refers_to"] in names for r in kept if r["record_type"] == "revisit")
    assert archives.warc_date("1999") == "1999-01-01T00:00:00Z"
    small = archives.read_warc(archives.arc_to_warc(arcs, revisit_bytes=5)).where("record_type = 'revisit'")
    assert small.count() == 0
    empty = archives.write_arc(table.limit(0))
    assert archives.read_warc(archives.arc_to_warc(empty)).count() == 0


def test_broken_archives():
    import io

    with pytest.raises(ValueError, match="version block"):
        list(archives.parse_arc(io.BytesIO(b"http://x 0.0.0.0 1 t 3\nabc\n"), "f"))
    head = archives._arc_opening(1)("n")
    with pytest.raises(ValueError, match="ends after"):
        list(archives.parse_arc(io.BytesIO(head + b"http://x 0.0.0.0 2000 t/h 30\nabc\n"), "f"))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_agrees_with_sql(spark, name):
    difference, rows = compare(spark, tables("/root/testdata/sf0.01"), name, "/root/testdata/sf0.01")
    assert difference is None and rows > 0


def test_registered():
    assert set(queries.QUERIES) <= set(contract.queries())
