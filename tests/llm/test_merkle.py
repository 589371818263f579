"""The manifest against a tree in plain Python, with other widths, ties, nulls and clashing names."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from matchcast.llm import merkle


@pytest.fixture
def documents(spark):
    """A frame of documents, with extra columns of names that the operator uses."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(rows, schema).selectExpr("*", "1 AS id", "2 AS g", "3 AS digest", "'x' AS n", "4 AS i", "'y' AS root", "5 AS `left`")

    return make


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def slow_leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def slow_tree(leaves, arity):
    """The root, and each leaf's digests to the left and right, level by level."""
    proofs, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        runs = [nodes[i : i + arity] for i in range(0, len(nodes), arity)]
        for leaf, i in enumerate(at):
            run = runs[i // arity]
            proofs[leaf].append(("".join(run[: i % arity]), "".join(run[i % arity + 1 :])))
        at, nodes = [i // arity for i in at], [digest(*run) for run in runs]
    return nodes[0], proofs


def slow_manifest(rows, arity):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        held = sorted((r[0] is not None, r[0] or 0, slow_leaf(r)) for r in groups[g])
        trees[g] = [h[2] for h in held], [h[1] if h[0] else None for h in held], *slow_tree([h[2] for h in held], arity)
    root, upper = slow_tree([trees[g][2] for g in names], arity)
    found = []
    for g, above in zip(names, upper):
        leaves, ids, subroot, proofs = trees[g]
        found += [(i, leaf, subroot, root, p + above) for i, leaf, p in zip(ids, leaves, proofs)]
    return found


def told(df):
    steps = F.transform("proof", lambda s: F.struct(*(merkle.hex_text(s[c]).alias(c) for c in ("left", "right"))))
    digests = [merkle.hex_text(F.col(c)) for c in ("leaf", "subroot", "root")]
    rows = df.select("id", *digests, steps).collect()
    return sorted(((r[0], r[1], r[2], r[3], [tuple(s) for s in r[4]]) for r in rows), key=repr)


@pytest.mark.parametrize("arity", [2, 3, 8])
def test_manifest_is_a_slow_tree(documents, arity):
    draw = random.Random(arity)
    rows = [(i, f"T{draw.random()}", draw.choice(["en", "en", "de", "é", "z", ""]), "s", i) for i in range(150)]
    rows += [(None, "n", "en", None, None), (7, "again", "en", None, 1), (7, "again", "en", None, 1), (3, None, None, None, None)]
    rows += [(1000, "a lone one", "lone", "s", 3), (1001, "x" * 300_000, "en", "s", 3), (1002, "", "de", "", 0)]
    found = told(merkle.manifest(documents(rows), arity=arity))
    slow = [(i, t, g, s, n) for i, t, g, s, n in rows]
    assert found == sorted(slow_manifest([(i, s, g, n, t) for i, t, g, s, n in slow], arity), key=repr)


def test_proofs_lead_to_the_root_and_tampering_shows(documents):
    docs = documents([(i, f"text {i}", "en" if i % 3 else None, "s", i) for i in range(70)])
    docs = docs.select("*", F.lit(2).alias("leaf"), F.lit(4).alias("tampered"))
    other = F.when(F.col("doc_id") == 33, merkle.leaf_hash([F.lit("other")]))
    found = merkle.manifest(docs, beside={"tampered": other})
    seen = found.select("id", (merkle.folded(F.coalesce("tampered", "leaf"), F.col("proof")) == F.col("root")).alias("ok")).collect()
    assert len(seen) == 70 and [r["id"] for r in seen if not r["ok"]] == [33]
    assert found.select("root").distinct().count() == 1


def test_small_manifests(documents):
    assert merkle.manifest(documents([])).count() == 0
    one = merkle.manifest(documents([(None, None, None, None, None)])).collect()
    assert one[0].leaf == one[0].subroot == one[0].root and one[0].proof == []
    assert one[0].leaf.hex() == digest("-----")


def test_a_hot_group_is_dealt_to_many_ranges(spark, documents):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    placed = merkle._numbered(docs.select(F.lit("=en").alias("g"), "doc_id"), ["doc_id"])
    assert placed.filter("i != doc_id OR n != 5000").count() == 0
    assert placed.select(F.max("i"), F.countDistinct("i")).first() == (4999, 5000)
