"""Merkle manifest of a dataset: a tree per group, a tree over the groups, and a proof for every row.

Each level is one self-join: a node asks for its siblings by their computed indices, and the rows of slot zero
emit the parents. Digests are held as 32 bytes; wherever they are hashed they enter as lower-case hex text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from matchcast.llm.common import release, settle

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def nothing() -> Column:
    return F.lit(bytearray())


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def joined_hash(*digests: Column) -> Column:
    """The digest of digests, which are written one after the other as hex text."""
    return F.unhex(F.sha2(hex_text(F.concat(*digests)), 256))


def leaf_hash(fields: list[Column]) -> Column:
    """The digest of a row: each field as its number of UTF-8 bytes, a colon and its value; a null is a dash."""
    written = [F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")) for f in fields]
    return F.unhex(F.sha2(F.concat(*(F.coalesce(w, F.lit("-")) for w in written)), 256))


def _numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with their place ``i`` (from 0) in their group ``g`` and the group's size ``n``.

    Rows are dealt to ranges of (group, order), so a group may hold any share of them. A row's place is its place in its
    range, behind the rows that its group has in earlier ranges.
    """
    ranged = nodes.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    placed = settle(ranged.withColumns({"slice": F.spark_partition_id(), "at": F.monotonically_increasing_id()}))
    parts = placed.groupBy("g", "slice").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    earlier = W.partitionBy("g").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.select(
        "g", "slice", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("start"),
        F.sum("rows").over(W.partitionBy("g")).alias("n"),
    )
    numbered = settle(placed.join(starts, ["g", "slice"]).withColumn("i", F.col("at") + F.col("start")).drop("slice", "at", "start"))
    release(placed)
    return numbered


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` with the digests of their run that stand to their ``left`` and ``right``, in order.

    The sibling of a binary tree has the index with its last bit turned; otherwise each of the other slots is asked for.
    """
    if arity == 2:
        asks = nodes.select("g", "i", F.col("i").bitwiseXOR(F.lit(1)).alias("j"))
    else:
        slot = F.pmod("i", F.lit(arity))
        shifts = F.explode(F.sequence(F.lit(1), F.lit(arity - 1))).alias("shift")
        asks = nodes.select("g", "i", shifts).select("g", "i", (F.col("i") - slot + F.pmod(slot + F.col("shift"), F.lit(arity))).alias("j"))
    told = nodes.select("g", F.col("i").alias("j"), F.col("digest").alias("d"))
    met = asks.join(told, ["g", "j"]).groupBy("g", "i").agg(F.array_sort(F.collect_list(F.struct("j", "d"))).alias("run"))

    def side(keep) -> Column:
        held = F.filter("run", keep)
        return F.coalesce(F.aggregate(held, nothing(), lambda done, s: F.concat(done, s["d"])), nothing())

    sides = {"left": side(lambda s: s["j"] < F.col("i")), "right": side(lambda s: s["j"] > F.col("i"))}
    return nodes.join(met, ["g", "i"], "left").withColumns(sides).drop("run")


def _levels(nodes: DataFrame, arity: int) -> list[DataFrame]:
    """The nodes ``g, i, n, digest, left, right`` of each level, from the leaves; a group ends where it has one node."""
    levels = []
    while True:
        several = nodes.filter("n > 1")
        single = nodes.filter("n = 1").withColumns({"left": nothing(), "right": nothing()})
        levels.append(settle(_with_siblings(several, arity).unionByName(single)))
        release(nodes)
        most = levels[-1].agg(F.max("n")).first()[0]
        if most is None or most == 1:
            return levels
        first = levels[-1].filter((F.col("n") > 1) & (F.pmod("i", F.lit(arity)) == 0))
        up = [F.floor(F.col("i") / arity).alias("i"), F.ceil(F.col("n") / arity).alias("n")]
        nodes = settle(first.select("g", *up, joined_hash(F.col("left"), F.col("digest"), F.col("right")).alias("digest")))


def _proofs(levels: list[DataFrame], above: DataFrame, arity: int) -> DataFrame:
    """The leaves with ``above``'s columns of their group, and their ``proof`` before ``above``'s.

    ``above`` has one row per group. Proofs are handed down: a level's nodes, an eighth of those below, carry theirs to their children.
    """
    kept = above.columns[1:]
    down = None
    for level in reversed(levels):
        rows = level.filter("n = 1").join(above, "g")
        if down is not None:
            step = F.array(F.struct("left", "right"))
            children = level.filter("n > 1").withColumn("p", F.floor(F.col("i") / arity))
            parents = down.select("g", F.col("i").alias("p"), *kept)
            rows = rows.unionByName(children.join(parents, ["g", "p"]).withColumn("proof", F.concat(step, "proof")).drop("p"))
        down = rows
    return down.drop("left", "right", "n")


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: tuple[str, ...] = FIELDS,
    arity: int = ARITY,
    beside: dict[str, Column] | None = None,
) -> DataFrame:
    """``id, leaf, subroot, root, proof`` for every row, and the columns of ``beside``.

    Leaves stand in the order of their ids within their group, and every ``arity`` nodes have one parent; groups stand
    bytewise, null first, as leaves of a last tree. ``proof`` lists, from the leaf to the root, the run's digests to the
    left and to the right. Digests are binary. Rows without an id come first; rows that share an id stand by their digests,
    and equal rows are leaves of their own. A text counts as its bytes, an empty one is not null. A group or table of one
    row is its own root, with empty steps or none. An empty table gives no rows. Other columns are not read.
    """
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaf = leaf_hash([F.col(f) for f in fields])
    extra = {f"beside_{k}": v for k, v in (beside or {}).items()}
    leaves = settle(docs.select(group.alias("g"), F.col(id_col).alias("id"), leaf.alias("digest"), *(v.alias(k) for k, v in extra.items())))
    levels = _levels(_numbered(leaves, ["id", "digest"]), arity)
    release(leaves)
    tops = reduce(DataFrame.unionByName, (level.filter("n = 1").select("g", "digest") for level in levels))
    subroots = settle(tops.select(F.lit("").alias("g"), F.col("g").alias("id"), "digest"))
    upper = _levels(_numbered(subroots, ["id"]), arity)
    no_steps = F.array().cast("array<struct<left:binary,right:binary>>").alias("proof")
    root = upper[-1].filter("n = 1").select("g", F.col("digest").alias("root"), no_steps)
    groups = _proofs(upper, root, arity).select(F.col("id").alias("g"), F.col("digest").alias("subroot"), "root", "proof")
    found = _proofs(levels, settle(groups), arity)
    return found.select("id", *(F.col(k).alias(k[len("beside_") :]) for k in extra), F.col("digest").alias("leaf"), "subroot", "root", "proof")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda done, step: joined_hash(step["left"], done, step["right"]))


def proof_hash(proof: Column) -> Column:
    """The digest of all siblings of a proof, from the leaf to the root, left to right."""
    return joined_hash(F.aggregate(proof, nothing(), lambda done, step: F.concat(done, step["left"], step["right"])))
