"""Near-duplicates: by SimHash, meeting in the middle between two fingerprints, and by similarity of shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from matchcast.llm.common import HOT_SHARE, SALTS, byte_texts, drop_rows, join_groups, map_arrow, release, settle, text_hash
from matchcast.llm.components import components

BITS = 64
SEED = 42
BLOCK = 1 << 15  # shingles whose bits are counted at a time


def _shingle_hashes(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of the text's word shingles, in blocks; fewer words than a shingle are one, none are none."""
    w = text.lower().split()  # bytes: A-Z and ASCII white space alone
    if not w:
        return
    n = max(len(w) - shingle + 1, 1)
    for start in range(0, n, BLOCK):
        part = w[start : min(start + BLOCK, n) + shingle - 1]
        joined = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if len(w) >= shingle else [b" ".join(w)]
        yield np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(SEED)), np.uint64)


def _ones(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit."""
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """A bit is 1 if it is set in over half of the hashes of the text's word shingles, repeats included."""
    ones, n = np.zeros(BITS, np.int64), 0
    for h in _shingle_hashes(text, shingle):
        ones += _ones(h)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_cols: list[str], text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id_cols, fp``: the fingerprint of every whole text as a signed long; null and blank texts have 0."""
    rows = docs.select(*id_cols, F.col(text_col).alias("_text"))

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in byte_texts(batch.column("_text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in id_cols), pa.array(fps, pa.int64())], [*id_cols, "fp"])

    return map_arrow(rows, run, rows.drop("_text").withColumn("fp", F.lit(0).cast("long")).schema)


def ball(radius: int) -> list[int]:
    """Masks of at most ``radius`` bits, as signed longs."""
    masks = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(BITS), k)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def fingerprint_links(distinct: DataFrame, distance: int = 2) -> DataFrame:
    """``(fa, fb)``: fingerprints at most ``distance`` apart, as chains that connect all that are linked.

    Each of the distinct ``fp`` emits all variants within half the distance; two fingerprints that
    are linked share a variant. A variant is shared by no more fingerprints than its ball has, 65 for
    distance 2, all within ``distance`` of one another; each is linked to the next of them, after
    their bits are compared. So every link's ends are connected, without all pairs of a group.
    """
    if distance % 2:
        raise ValueError("the distance is even: both fingerprints meet halfway")
    masks = F.array(*[F.lit(m).cast("long") for m in ball(distance // 2)])
    variants = distinct.select("fp", F.explode(masks).alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("v"))
    before = F.lag("fp").over(W.partitionBy("v").orderBy("fp"))
    pairs = variants.withColumn("fa", before).filter("fa IS NOT NULL").select("fa", F.col("fp").alias("fb"))
    near = F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= distance
    return pairs.filter(near).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 2, shingle: int = 3) -> DataFrame:
    """``id, h, fp, root`` for every row: linked rows share the smallest id of all they reach.

    Rows of equal fingerprints are one node, the smallest id among them, before variants are made, so
    copies cost nothing further. Rows that share an id are one document. A row without an id has
    the root of its fingerprint; a fingerprint that only rows without id have is linked to
    no other, and its root is null. ``distance`` is even.
    ``h`` is a hash of the text, which with the id names a row. An empty table gives no rows.
    """
    named_rows = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("h"), F.col(text_col).alias("t"))
    rows = settle(fingerprints(named_rows, ["id", "h"], "t", shingle))
    nodes = settle(rows.groupBy("fp").agg(F.min("id").alias("node"), F.count("*").alias("n")))
    named = nodes.filter("node IS NOT NULL").select("fp", "node")
    links = fingerprint_links(named.select("fp"), distance)
    ends = links.join(named.select(F.col("fp").alias("fa"), F.col("node").alias("a")), "fa").join(
        named.select(F.col("fp").alias("fb"), F.col("node").alias("b")), "fb"
    )
    return _with_roots(rows, nodes, "fp", ends.select("a", "b"))


def _with_roots(rows: DataFrame, nodes: DataFrame, fp: str, links: DataFrame) -> DataFrame:
    """The root of each row: of the links, and of rows that share an id."""
    named = nodes.filter("node IS NOT NULL").select(fp, "node")
    several = rows.filter("id IS NOT NULL").groupBy("id").agg(F.min(fp).alias("x"), F.max(fp).alias("y")).filter("x != y")
    same = rows.join(several.select("id"), "id").join(named, fp).select(F.col("id").alias("a"), F.col("node").alias("b"))
    roots = components(links.unionByName(same))
    placed = settle(nodes.join(roots, "node", "left").select(fp, F.coalesce("root", "node").alias("root"), "n"))
    return join_groups(rows, placed, [fp], "n", F.struct("id", "h"))


COMMON_SHARE = 64  # one document in so many is looked at to tell which shingles are common
COMMON_MOST = 1 << 17  # common shingles that are told to the scans: 1 MB, whatever the corpus's size
EARLY = 6  # the first shingles of a prefix, which make the chains of the first round
SLOTS = 256  # of the counts that tell how much two sets can share at most


def shingle_set(text: bytes, shingle: int = 5) -> np.ndarray:
    """The distinct hashes of the text's word shingles, ascending."""
    return np.unique(np.concatenate([*_shingle_hashes(text, shingle), np.zeros(0, np.uint64)]))


def rare_first(grams: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The hashes in one order for all texts: those not in ``common`` as they are, then the common ones by rank."""
    if not len(common):
        return grams
    at = np.minimum(np.searchsorted(common, grams), len(common) - 1)
    known = common[at] == grams
    return np.concatenate([grams[~known], grams[known][np.argsort(rank[at[known]])]])


def _common(rows: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes that a sample of ``rows(id, h, t)`` has several times, ascending, their places by frequency, and the hot ones.

    Hot are those that more than a thousandth of the sample has, and over 20 texts of it.
    """
    part = rows.filter(F.pmod(F.xxhash64("id", "h"), F.lit(COMMON_SHARE)) == 0).select("t")
    least = max(part.count() // HOT_SHARE, 20)

    def run(batches):
        for batch in batches:
            found = [shingle_set(t, shingle).view(np.int64) for t in byte_texts(batch.column("t"))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, np.zeros(0, np.int64)]), pa.int64())], ["gram"])

    counts = map_arrow(part, run, "gram long").groupBy("gram").agg(F.count("*").alias("n")).filter("n > 2")
    listed = counts.orderBy(F.desc("n"), "gram").limit(COMMON_MOST).collect()
    grams = np.array([r["gram"] for r in listed], np.int64).view(np.uint64)
    hot = np.sort(grams[[r["n"] > least for r in listed]])
    order = np.argsort(grams)
    return grams[order], (len(grams) - np.arange(len(grams)))[order], hot


def slot_counts(grams: np.ndarray) -> bytes:
    """How many of the hashes fall to each slot, a byte each; 255 stands for that or more."""
    return np.minimum(np.bincount((grams % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS), 255).astype(np.uint8).tobytes()


def _with_ends(pairs: DataFrame, told: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` with columns of both ends from ``told(node, pairs, ...)``; a node may stand in most pairs."""
    for end, other in ("ab", "ba"):
        one = told.select(F.col("node").alias(end), "pairs", *(F.col(c).alias(f"{c}_{end}") for c in columns))
        pairs = join_groups(pairs, one, [end], "pairs", F.col(other), "inner").drop("pairs")
    return pairs


def _possible(pairs: DataFrame, nodes: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """``pairs`` without those whose counts by slot rule out that they share enough, and their nodes with their number of pairs."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    told = settle(nodes.join(ends.groupBy("node").agg(F.count("*").alias("pairs")), "node").select("node", "h", "n", "slots", "pairs"))
    both = _with_ends(pairs, told, ["n", "slots"]).select("a", "b", "n_a", "n_b", "slots_a", "slots_b")

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SLOTS) for c in ("slots_a", "slots_b"))
            least = np.minimum(x, y)
            most = least.sum(axis=1, dtype=np.int64)
            sizes = sum(batch.column(c).to_numpy().astype(np.int64) for c in ("n_a", "n_b"))
            kept = (most * (1 + similarity) >= similarity * sizes - 1e-9) | (least == 255).any(axis=1)
            yield batch.select(["a", "b"]).filter(pa.array(kept))

    return settle(map_arrow(both, run, pairs.schema)), told


def _verified(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """Those of ``(a, b)`` whose sets of shingles have at least the similarity, read again from the texts."""
    possible, told = _possible(pairs, nodes, similarity)
    ends = possible.select(F.col("a").alias("node")).unionByName(possible.select(F.col("b").alias("node")))
    wanted = settle(told.drop("pairs").join(ends.groupBy("node").agg(F.count("*").alias("pairs")), "node").select(F.col("node").alias("id"), "h", "pairs"))
    texts = rows.join(wanted, ["id", "h"], "left_semi").select("id", "t")

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t, shingle).view(np.int64) for t in byte_texts(batch.column("t"))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.list_(pa.int64()))], ["node", "grams"])

    kind = rows.schema["id"].dataType.simpleString()
    sets = settle(map_arrow(texts, run, f"node {kind}, grams array<long>"))
    first = sets.groupBy("node").agg(F.first("grams").alias("grams"))  # a document may stand in several rows
    one = settle(first.join(wanted.select(F.col("id").alias("node"), "pairs"), "node"))
    both = _with_ends(possible, one, ["grams"])
    same = F.size(F.array_intersect("grams_a", "grams_b"))
    links = settle(both.filter(same * (1 + similarity) >= similarity * (F.size("grams_a") + F.size("grams_b")) - 1e-9).select("a", "b"))
    for done in (pairs, possible, told, wanted, sets, one):
        release(done)
    return links


def set_links(nodes: DataFrame, rows: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """``(a, b)``: nodes ``(node, h, n, prefix, hot, slots)`` whose sets have at least this similarity, enough to connect all that have.

    With all shingles in one order, two such sets share one among the first ``n - ceil(similarity * n) + 1``
    of either, and behind the first that they share either has as many as must be common: pairs are
    compared if that holds at a shingle they share, and none that is alike is lost by it.
    In a first round each node is held against the one before it on the first shingles of its prefix, and on each of its shingles
    against the node that has it foremost: of many copies of a text that is the one with the fewest changes, which most of
    them are like. The last ``hot`` shingles of a prefix are dealt to many tasks in 64 parts, with a foremost node each;
    a second round holds all that are not yet connected against the foremost of all. In the last, every two nodes that meet and are
    still not connected are compared, however many meet on a shingle.
    """
    posted = nodes.select("node", "n", (F.size("prefix") - F.col("hot")).alias("hot"), F.posexplode("prefix").alias("place", "gram"))
    hot = F.col("place") >= F.col("hot")
    posted = posted.withColumn("salt", F.when(hot, F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).otherwise(F.lit(-1))).drop("hot")
    order = W.partitionBy("gram", "salt").orderBy("place", "n", "node")
    held = F.struct("node", "n", "place")
    beside = posted.withColumns({"before": F.lag(held).over(order), "foremost": F.first(held).over(order), "after": F.lead("node").over(order)})
    met = settle(beside.filter("before IS NOT NULL OR after IS NOT NULL OR salt >= 0").drop("after", "salt"))

    def fit(x: str, y: str) -> Column:
        left = F.least(F.col(f"{x}.n") - F.col(f"{x}.place"), F.col(f"{y}.n") - F.col(f"{y}.place"))
        return left * (1 + similarity) >= similarity * (F.col(f"{x}.n") + F.col(f"{y}.n")) - 1e-9

    def ends(x: str, y: str) -> list[Column]:
        return [f(f"{x}.node", f"{y}.node").alias(c) for f, c in ((F.least, "a"), (F.greatest, "b"))]

    chained = met.alias("x").filter(F.col("place") < EARLY).filter(fit("x", "before")).select(*ends("x", "before"))
    starred = met.alias("x").filter("x.node != foremost.node").filter(fit("x", "foremost")).select(*ends("x", "foremost"))
    links = _verified(settle(chained.unionByName(starred).distinct()), nodes, rows, similarity, shingle)
    bare = met.drop("before", "foremost")

    def still_open(links: DataFrame) -> DataFrame:
        """Postings of the shingles on which nodes of several roots meet, with their roots."""
        roots = settle(components(links))
        placed = settle(bare.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
        several = placed.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high")
        found = settle(placed.join(several.select("gram"), "gram", "left_semi"))
        release(placed)
        release(roots)
        return found

    open_ = still_open(links)
    first = F.min(F.struct("place", "n", "node", "root")).alias("y")
    heads = settle(open_.groupBy("gram").agg(first, F.count("*").alias("posts")))
    across = join_groups(open_, heads, ["gram"], "posts", F.col("node"), "inner").alias("x").filter("x.root != y.root").filter(fit("x", "y"))
    more = _verified(settle(across.select(*ends("x", "y")).distinct()), nodes, rows, similarity, shingle)
    release(heads)
    release(open_)
    links = links.unionByName(more)
    open_ = still_open(links)
    release(met)
    heads = open_.groupBy("gram", "root").agg(F.max(F.col("n") - F.col("place")).alias("most"), F.min("n").alias("least"))
    x, y = heads.alias("x"), heads.alias("y")
    may = F.least("x.most", "y.most") * (1 + similarity) >= similarity * (F.col("x.least") + F.col("y.least")) - 1e-9
    apart = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.root") < F.col("y.root")) & may)
    apart = apart.select(F.col("x.gram").alias("gram"), F.col("x.root").alias("root"), F.col("y.root").alias("other"))
    left = open_.join(apart, ["gram", "root"]).alias("x")
    right = open_.alias("y")
    pairs = left.join(right, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.other") == F.col("y.root")) & fit("x", "y"))
    rest = _verified(settle(pairs.select(*ends("x", "y")).distinct()), nodes, rows, similarity, shingle)
    release(open_)
    return links.unionByName(rest)


def similar_documents(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, id_col="doc_id", text_col="text") -> DataFrame:
    """``id, h, root`` for every row, as ``near_duplicates`` gives them, by similarity of the sets of word shingles.

    The similarity is that of the sets (of 64-bit hashes), and no pair that has it is left out, at any size.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("h"), F.col(text_col).alias("t"))
    *order, hot = _common(rows, shingle)
    shared = docs.sparkSession.sparkContext.broadcast((order, hot))

    def run(batches):
        order, hot = shared.value
        for batch in batches:
            marks, sizes, prefixes, hots, slots = [], [], [], [], []
            for text in byte_texts(batch.column("t")):
                grams = shingle_set(text, shingle)
                marks.append(np.frombuffer(xxhash.xxh3_128_digest(grams.tobytes()), np.int64))
                sizes.append(len(grams))
                slots.append(slot_counts(grams))
                kept = len(grams) - math.ceil(similarity * len(grams) - 1e-9) + 1 if len(grams) else 0
                prefix = rare_first(grams, *order)[:kept]
                hots.append(int(np.isin(prefix, hot).sum()))
                prefixes.append(prefix.view(np.int64))
            longs = pa.list_(pa.int64())
            columns = [pa.array(marks, longs), pa.array(sizes, pa.int32()), pa.array(prefixes, longs), pa.array(hots, pa.int32()), pa.array(slots, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("h"), *columns], ["id", "h", "words", "size", "prefix", "hot", "slots"])

    kind = docs.schema[id_col].dataType.simpleString()
    printed = settle(map_arrow(rows, run, f"id {kind}, h long, words array<long>, size int, prefix array<long>, hot int, slots binary"))
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "h"))).alias("first")
    same = [F.first(c).alias(c) for c in ("size", "prefix", "hot", "slots")]
    whole = printed.groupBy("words").agg(first, F.count("*").alias("n"), *same)
    whole = settle(whole.select("words", F.col("first.id").alias("node"), F.col("first.h").alias("h"), "n", "size", "prefix", "hot", "slots"))
    sets = whole.filter("node IS NOT NULL").select("node", "h", F.col("size").alias("n"), "prefix", "hot", "slots")
    links = set_links(sets, rows, similarity, shingle)
    return _with_roots(printed.select("id", "h", "words"), whole.select("words", "node", "n"), "words", links)


def keep_first(docs: DataFrame, similarity: float = 0.8, shingle: int = 5) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id, all columns as they were.

    Two documents are linked by SimHash, if their fingerprints differ in 2 bits at most, and by similarity of their sets,
    which finds near copies that differ in more bits; a group is all that links of either kind connect.
    A row without an id goes if its text is like that of a row with one.
    """
    printed = settle(near_duplicates(docs).select("id", "h", "root"))
    found = settle(similar_documents(docs, similarity, shingle).select("id", "h", "root"))
    both = printed.unionByName(found)
    links = both.filter("id != root").select(F.col("id").alias("a"), F.col("root").alias("b"))
    later = components(links).filter("node != root").select(F.col("node").alias("id"))
    named = both.join(later, "id", "left_semi").select("id", "h")
    gone = settle(named.unionByName(both.filter("id IS NULL AND root IS NOT NULL").select("id", "h")).distinct())
    release(printed)
    release(found)
    return drop_rows(docs, gone)
