"""Phrase mining against plain counting; quotient filters give back what was put in."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerlark.llm import phrases, quotient_filter
from ledgerlark.llm.quotient_filter import KeySpace
from tests.check_oracle import compare, tables

SCHEMA = "lang string, text string, shard int, words string, n string, f int, id int, k string"


def plain(rows, least, longest=5, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, found in counts.items():
        kept = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        covered = Counter()
        for p, a in kept.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    covered[p[i : i + size]] = max(covered[p[i : i + size]], a)
        ranked = []
        for p, a in kept.items():
            if covered[p] >= a:
                continue
            n = total[lang]
            cuts = [(1000 * a * n // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]], n))
        for rank, (s, a, p, left, right, n) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def mined(spark, rows, **options):
    table = spark.createDataFrame([(*r, 1, "w", "n", 2, 3, "k") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in phrases.collocations(table, **options).collect())


def mixture(seed, n):
    r = random.Random(seed)
    words = ["a", "B", "the", "é", "😀x", "no break", "x\x00y", "Of", "of", "long" * 50]
    ends = [" ", "  ", "\t", ", ", ". ", "\n", "!?", " ; "]
    return "".join(w + e for w, e in zip(r.choices(words, range(10, 0, -1), k=n), r.choices(ends, (20, 2, 2, 1, 1, 1, 1, 1), k=n)))


ODD = [
    (None, mixture(1, 400)), ("en", mixture(2, 3000)), ("en", None), (None, None), ("en", ""), ("", mixture(3, 500)),
    ("de", " \t\n.,"), ("de", "only"), ("en", "again and again and again " * 20), ("en", "again and again and again " * 20),
]


@pytest.mark.parametrize("least, longest, top", [(3, 5, 2000), (8, 3, 4)])
def test_against_plain_counts(spark, least, longest, top):
    found = mined(spark, ODD, least=least, longest=longest, top=top)
    assert found and found == plain(ODD, least, longest, top)


def test_no_rows_and_no_phrases(spark):
    assert mined(spark, []) == []
    assert mined(spark, [("en", "a b c"), (None, None)]) == []


def test_long_texts_are_parted_between_pieces():
    data = b"a b c. " * 1000 + b"x" * 500 + b" d. " + b"e f"
    parts = list(phrases._parts(data, 100))
    assert b".".join(parts) == data and max(map(len, parts)) <= 600
    assert list(phrases._parts(b"no break at all" * 100, 10)) == [b"no break at all" * 100]


@pytest.mark.parametrize("size", [2, 3, 4, 5])
@pytest.mark.parametrize("bits", [1, 7, 15, 25])
def test_filters_lose_nothing(size, bits):
    r = np.random.default_rng(size * 100 + bits)
    numbers = r.integers(0, 1 << bits, 5000).astype(np.int32)
    starts = np.arange(len(numbers) - size + 1)
    rows = Counter(map(tuple, np.stack([numbers[starts + i] for i in range(size)], 1).tolist()))
    space = KeySpace(-(-size * bits // 2), size * bits // 2, min(3, -(-size * bits // 2)))
    left, right, place = space.distinct(*space.permute(*phrases.packed(numbers, starts, size, bits)))
    counts = np.bincount(place) * 100
    back = Counter()
    blocks, edges = space.edges(left)
    for block, a, b in zip(blocks.tolist(), edges, edges[1:]):
        data = quotient_filter.encode(space, left[a:b], right[a:b], counts[a:b])
        one = quotient_filter.decode(space, block, data)
        merged = quotient_filter.merge(space, [one, one])
        assert all((x == y).all() for x, y in zip(merged[3], [np.arange(b - a)] * 2))
        ids = phrases.unpacked(*space.restore(*merged[:2]), size, bits)
        back.update({tuple(w): c for w, c in zip(ids.tolist(), merged[2].tolist())})
    assert back == Counter({k: 200 * c for k, c in rows.items()})


def test_query_agrees_with_sql(spark):
    database = tables("/root/testdata/sf0.01")
    assert compare(spark, database, "op11_phrase_collocations", "/root/testdata/sf0.01")[0] is None
