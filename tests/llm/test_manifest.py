"""The Merkle manifest against a plain tree, with null, empty, long, repeated and clashing input."""

import hashlib
import zlib

import pytest

import __spark_entry__ as contract
from ledgerlark.llm import merkle
from pyspark.sql import functions as F
from tests.check_oracle import compare, tables

SCHEMA = "doc_id bigint, source string, text string, tree string, idx int, n string, block int"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def entry(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain(leaves):
    """(root, [siblings of each level of each leaf])."""
    proofs, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for proof, i in zip(proofs, at, strict=True):
            low = i - i % 3
            proof.append(("".join(level[low:i]), "".join(level[i + 1 : low + 3])))
        level = [digest(*level[i : i + 3]) for i in range(0, len(level), 3)]
        at = [i // 3 for i in at]
    return level[0], proofs


def expected(rows):
    """{(id, leaf): sorted [(subroot, root, path)]}"""
    trees = {}
    for id, source, text in rows:
        trees.setdefault(source, []).append((id, digest(entry(id), entry(source), entry(text))))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for source in order:
        trees[source].sort(key=lambda x: (x[0] is not None, x))
        built[source] = plain([leaf for _, leaf in trees[source]])
    root, tops = plain([built[s][0] for s in order])
    out = {}
    for source, top in zip(order, tops, strict=True):
        for key, proof in zip(trees[source], built[source][1], strict=True):
            out.setdefault(key, []).append((built[source][0], root, proof + top))
    return {k: sorted(v) for k, v in out.items()}


def found(spark, rows, height):
    table = spark.createDataFrame([(*r, "t", 1, "n", 2) for r in rows], SCHEMA)
    leaf = merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("text"))
    out = {}
    proofs = merkle.manifest(table.withColumn("leaf", leaf), id="doc_id", group="source", leaf="leaf", height=height)
    checked = proofs.withColumn("folded", merkle.folded(F.col("leaf"), F.col("path")))
    for r in checked.collect():
        assert r["folded"] == r["root"]
        path = [(p["before"], p["after"]) for p in r["path"]]
        out.setdefault((r["doc_id"], r["leaf"]), []).append((r["subroot"], r["root"], path))
    return {k: sorted(v) for k, v in out.items()}


ODD = [
    (1, "a", None), (2, "a", ""), (3, "a", "-"), (4, "a", "x" * 300_000), (5, None, "n"), (6, "", "e"), (7, "ü", "é😀\n"),
    (None, "a", "no id"), (None, None, None), (8, "z", "same"), (8, "z", "same"), (8, "z", "other"), (-9, "a", "0:"),
]


MANY = [(i * 7 % 100, f"s{i % 3 if i < 60 else 0}", f"text {i}") for i in range(100)]


@pytest.mark.parametrize(
    "rows, height", [(MANY, 1), (ODD, 2), (ODD, 7), ([(1, "a", "alone")], 7), ([(1, "s", "copy")] * 40, 2)]
)
def test_against_plain_tree(spark, rows, height):
    assert found(spark, rows, height) == expected(rows)


def test_empty_table(spark):
    assert found(spark, [], 2) == {}


def test_positions_are_completion_order():
    """The closed form addresses every node of a log, whatever the last runs hold."""
    for leaves in range(1, 90):
        height = merkle.height_of(leaves)
        log = merkle.build([f"{i:064x}" for i in range(leaves)], height)
        at = merkle.addresses(leaves, height)
        assert sorted(p for level in at for p in level.tolist()) == list(range(len(log)))
        level = [f"{i:064x}" for i in range(leaves)]
        for places in at:
            assert [log[p] for p in places.tolist()] == level
            level = [digest(*level[i : i + 3]) for i in range(0, len(level), 3)]
    assert merkle.first_position(27, 4) == 27 + 9 + 3 + 1


def test_tampering_is_found(spark):
    rows = [(i, "s", f"line\n{i}") for i in range(30)]
    table = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    columns = [F.col("doc_id"), F.col("source")]
    changed = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"))).otherwise(F.col("text"))
    table = table.select(
        "doc_id", "source", merkle.leaf_digest(*columns, F.col("text")).alias("leaf"),
        merkle.leaf_digest(*columns, changed).alias("claimed"),
    )
    proofs = merkle.manifest(table, id="doc_id", group="source", leaf="leaf", carry=["claimed"])
    for row in proofs.withColumn("folded", merkle.folded(F.col("claimed"), F.col("path"))).collect():
        assert (row["folded"] == row["root"]) == (row["doc_id"] % 2 == 1)


def test_query_agrees_with_sql(spark):
    assert zlib.crc32(b"1") % 2 == 1  # both kinds of ids are among the first
    database = tables("/root/testdata/sf0.001")
    difference, rows = compare(spark, database, "op12_merkle_manifest", "/root/testdata/sf0.001")
    assert difference is None and rows == 200
    assert contract.oracle_sql()["op12_merkle_manifest"]
