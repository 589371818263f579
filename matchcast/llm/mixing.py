"""Mixing sources to target weights: quotas of permuted blocks, dealt to output shards by a splitting tree."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchcast.llm.common import settle, text_hash

WEIGHTS = (5, 2, 1)
TOTAL = 1.5  # words of the mix, as a share of all words
MOST = 2  # times a source's own words, and a document's
SHARDS = 64
DIGITS = 15  # hex digits of a document's place in the permutation of its source
STEP = 2  # digits a descent takes at a time: 256 blocks a source and round
FEW = 256  # rows of a block that are looked at one by one


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def place(id_col: Column, text: Column, seed: str) -> Column:
    """A document's place in a permutation that its id, its text and the seed decide: hex digits, compared as text."""
    written = F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary")), F.lit(seed))
    return F.substring(F.md5(written.cast("binary")), 1, DIGITS)


def water_level(sizes: list[int], weights: list[int], total: float, most: int) -> list[float]:
    """Targets by weight; what exceeds ``most`` times a source's size is reshared until none does."""
    order = sorted(range(len(sizes)), key=lambda i: (sizes[i] / weights[i], i))
    capped, weight, targets = 0, sum(weights), [0.0] * len(sizes)
    for k, i in enumerate(order):
        level = (total - capped) / weight
        if level * weights[i] <= most * sizes[i]:
            for j in order[k:]:
                targets[j] = level * weights[j]
            break
        targets[i] = float(most * sizes[i])
        capped += most * sizes[i]
        weight -= weights[i]
    return targets


@dataclass
class Quota:
    """What one source gives: whole copies of all its documents, and the first ``rest`` words of the permutation."""

    source: str | None
    size: int
    target: float
    copies: int
    rest: float
    cut: str = ""  # documents whose place is below it are taken once more

    @property
    def key(self) -> str:
        return "-" if self.source is None else "+" + self.source


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("+"), source), F.lit("-"))


def _descend(rows: DataFrame, quotas: list[Quota]) -> None:
    """Find each source's cut: round by round into the block where its words run out.

    A round sums the words of a block's 256 parts for each source, so no source is sorted; a block
    of at most 256 documents is looked at one by one. Rows of one place, that is equal ones, are
    taken or left together.
    """
    open_at = {q.key: ("", 0) for q in quotas if q.rest > 0}  # the block's prefix and the words before it
    by_key = {q.key: q for q in quotas}
    spark = rows.sparkSession
    while open_at:
        states = spark.createDataFrame([(k, p) for k, (p, _) in open_at.items()], "key string, prefix string")
        depth = len(next(iter(open_at.values()))[0])
        inside = rows.join(F.broadcast(states), "key").filter(F.substring("place", 1, depth) == F.col("prefix"))
        parts = inside.groupBy("key", F.substring("place", 1, depth + STEP).alias("part"))
        sums: dict[str, list] = {}
        for r in parts.agg(F.sum("size").alias("w"), F.count("*").alias("n")).collect():
            sums.setdefault(r["key"], []).append((r["part"], r["w"], r["n"]))
        few, deeper = {}, {}
        for key, (_, before) in open_at.items():
            rest, last = by_key[key].rest, None
            for part, w, n in sorted(sums.get(key, [])):
                if before + w > rest:
                    last = (part, n)
                    break
                before += w
            if last is None:
                by_key[key].cut = "g"  # above all hex digits: every document
            elif last[1] <= FEW or depth + STEP >= DIGITS:
                few[key] = (last[0], before)
            else:
                deeper[key] = (last[0], before)
        if few:
            wanted = spark.createDataFrame([(k, p) for k, (p, _) in few.items()], "key string, prefix string")
            near = rows.join(F.broadcast(wanted), "key").filter(F.substring("place", 1, len(next(iter(few.values()))[0])) == F.col("prefix"))
            single: dict[str, list] = {}
            for r in near.groupBy("key", "place").agg(F.sum("size").alias("w")).collect():
                single.setdefault(r["key"], []).append((r["place"], r["w"]))
            for key, (_, before) in few.items():
                q = by_key[key]
                q.cut = "g"
                for at, w in sorted(single[key]):
                    if before + w / 2 > q.rest:
                        q.cut = at
                        break
                    before += w
                else:
                    q.cut = few[key][0] + "g"
        open_at = deeper


def split_tree(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """``shards x sources`` block counts: each node draws its left half's share from a multivariate hypergeometric law.

    Every column sums to its quota, and shards hold equally many blocks, up to one.
    """
    out = np.zeros((shards, len(quotas)), np.int64)
    rng = np.random.default_rng(seed)

    def deal(first: int, last: int, left: np.ndarray) -> None:
        if last - first == 1:
            out[first] = left
            return
        middle = (first + last) // 2
        total = int(left.sum())
        drawn = rng.multivariate_hypergeometric(left, total * (middle - first) // (last - first), method="marginals")
        deal(first, middle, drawn)
        deal(middle, last, left - drawn)

    deal(0, shards, quotas.astype(np.int64))
    return out


def plan(spark: SparkSession, rows: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: int = MOST) -> list[Quota]:
    """The quota of each source of ``rows(key, source, size, place)``; the driver holds one entry a source."""
    found = rows.groupBy("key", "source").agg(F.sum("size").alias("size")).collect()
    found.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [r["size"] for r in found]
    targets = water_level(sizes, [weights[i % len(weights)] for i in range(len(found))], total * sum(sizes), most)
    quotas = []
    for r, size, target in zip(found, sizes, targets):
        copies = min(int(target // size), most) if size else 0
        quotas.append(Quota(r["source"], size, target, copies, target - copies * size if copies < most else 0.0))
    _descend(rows, quotas)
    return quotas


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", seed: str = "mix", shards: int = SHARDS) -> DataFrame:
    """``id, h, size, source_size, target, taken, copies, shards``: one row per document of the mix's plan.

    A source's documents stand in a permuted order, which a hash of id and text decides, in 256 blocks. Its quota is a
    number of blocks: all of them for each whole copy, and then the first ones up to its target, the last of which
    gives documents until the target is met to within half a document. The tree divides the quotas among the outputs, each
    output draws blocks that no other has drawn, and a document is taken by each output that drew its block:
    ``shards`` lists them, ``copies`` counts them. Null sources are one source, the last; null texts have no words. Rows
    that share an id are told apart by their texts, equal rows are taken alike. A source without words has the target 0. An
    empty table gives no rows. Reruns agree, as nothing depends on the order of rows.
    """
    spark = docs.sparkSession
    rows = settle(
        docs.select(
            F.col(id_col).alias("id"), text_hash(text_col).alias("h"), F.col(source_col).alias("source"),
            source_key(F.col(source_col)).alias("key"), word_count(F.col(text_col)).alias("size"),
            place(F.col(id_col), F.col(text_col), seed).alias("place"),
        )
    )
    quotas = plan(spark, rows)
    blocks = 16**STEP
    drawn = np.array([q.copies * blocks + _blocks_below(q.cut) for q in quotas], np.int64)
    dealt = split_tree(drawn, shards, 7) if quotas else np.zeros((shards, 0), np.int64)
    sources = spark.createDataFrame([(q.key, q.size, q.target) for q in quotas], "key string, source_size long, target double")
    drawn_by = spark.createDataFrame(draws(quotas, dealt), "key string, block int, outputs array<struct<shard:int,cut:string>>")
    block = F.conv(F.substring("place", 1, STEP), 16, 10).cast("int")
    joined = rows.withColumn("block", block).join(sources, "key").join(drawn_by, ["key", "block"], "left")
    taking = F.filter("outputs", lambda o: F.col("place") < o["cut"])
    taken_by = F.coalesce(F.transform(taking, lambda o: o["shard"]), F.array().cast("array<int>"))
    return joined.withColumn("shards", taken_by).withColumn("copies", F.size("shards")).select(
        "id", "h", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "shards"
    )


def draws(quotas: list[Quota], dealt: np.ndarray) -> list[tuple]:
    """``key, block, outputs``: who drew each block of each source, and up to which place its documents go there.

    A source's blocks are numbered copy by copy; the outputs draw as many as the tree dealt them, in a permuted order.
    """
    blocks, found = 16**STEP, []
    for i, q in enumerate(quotas):
        outputs = np.random.default_rng([7, i]).permutation(np.repeat(np.arange(len(dealt)), dealt[:, i]))
        by_block: dict[int, list] = {}
        for number, shard in enumerate(outputs.tolist()):
            copy, block = divmod(number, blocks)
            by_block.setdefault(block, []).append((shard, "g" if copy < q.copies else q.cut))
        found += [(q.key, block, held) for block, held in by_block.items()]
    return found


def _blocks_below(cut: str) -> int:
    """How many of a source's 256 blocks have documents below the cut."""
    if not cut:
        return 0
    return 16**STEP if cut[0] == "g" else int(cut[:STEP], 16) + 1


def write_order(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The mix itself: each document as often as it is taken.

    Added are ``mix_copy``, ``mix_shard`` and ``mix_order``: a shard's documents, sorted by the last, are shuffled.
    Input columns of these names are replaced; any others stay.
    """
    docs = docs.drop("mix_copy", "mix_shard", "mix_order")
    taken = mix(docs, seed=seed).filter("copies > 0")
    planned = settle(taken.select("id", "h", F.posexplode("shards").alias("copy", "shard")).distinct())
    listed = planned.select(*(F.col(c).alias(f"_mix_{c}") for c in planned.columns))
    keyed = docs.select("*", F.col("doc_id").alias("_id"), text_hash("text").alias("_h"))
    same = F.col("_id").eqNullSafe(F.col("_mix_id")) & (F.col("_h") == F.col("_mix_h"))
    drawn = F.concat_ws(":", F.lit(seed), "_id", "_h", "_mix_shard", "_mix_copy")
    return keyed.join(listed, same).select(
        *(F.col(f"`{c}`") for c in docs.columns), F.col("_mix_copy").alias("mix_copy"),
        F.col("_mix_shard").alias("mix_shard"), F.md5(drawn.cast("binary")).alias("mix_order"),
    )
