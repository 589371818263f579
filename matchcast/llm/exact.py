"""Exact duplicates by recipes of content-defined chunks."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchcast.llm.common import byte_texts, drop_rows, join_groups, keep_rows, map_arrow, settle, text_hash

WINDOW = 16  # bytes that decide whether a chunk ends after them
LEAST = 512  # bytes of a chunk, unless its text ends
MASK_BITS = 11  # a boundary every 2**MASK_BITS places, on average
PIECE = 1 << 18  # bytes that are scanned at a time


def chunk_ends(text: bytes) -> list[int]:
    """Where the chunks of a text end; equal texts are cut alike, and an insertion moves few cuts."""
    n, ends, last = len(text), [], 0
    data = np.frombuffer(text, np.uint8)
    for start in range(0, n - WINDOW + 1, PIECE):
        part = data[start : start + PIECE + WINDOW - 1]
        words = np.lib.stride_tricks.sliding_window_view(part, 8)
        word = np.ascontiguousarray(words).view(np.uint64)[:, 0]
        h = (word[:-8] * np.uint64(0x9E3779B97F4A7C15)) ^ (word[8:] * np.uint64(0xC2B2AE3D27D4EB4F))
        h *= np.uint64(0x165667B19E3779F9)
        for end in (np.flatnonzero(h >> np.uint64(64 - MASK_BITS) == 0) + (start + WINDOW)).tolist():
            if end - last >= LEAST and end < n:
                ends.append(end)
                last = end
    return [*ends, n] if n else []


def _recipes(batches):
    for batch in batches:
        shas, sizes, hashes, digests = [], [], [], []
        for text in byte_texts(batch.column("t")):
            ends = chunk_ends(text)
            chunks = [text[a:b] for a, b in zip([0, *ends], ends)]
            shas.append(hashlib.sha256(text).hexdigest())
            sizes.append(len(text))
            hashes.append([xxhash.xxh64_hexdigest(c) for c in chunks])
            digests.append([hashlib.sha256(c).hexdigest() for c in chunks])
        strings = pa.list_(pa.string())
        columns = [batch.column("id"), batch.column("h"), pa.array(shas, pa.string()), pa.array(sizes, pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(hashes, strings), pa.array(digests, strings)], ["id", "h", "sha", "size", "hashes", "digests"]
        )


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, h, sha, size, recipe``: each text as the ordered list of its chunks' identifiers.

    An identifier is a chunk's 64-bit hash, verified over all chunks of all texts against
    SHA-256: a hash that two different chunks have is replaced by the hash with the digest. The hashes
    so replaced come to the driver; by the birthday bound that is about n*n/2**65 of n chunks. Chunks
    themselves are not moved, only their digests, combined before the shuffle.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("h"), F.col(text_col).alias("t"))
    schema = rows.select("id", "h").schema.simpleString()[len("struct<") : -1].replace(":", " ")
    cut = settle(map_arrow(rows, _recipes, f"{schema}, sha string, size long, hashes array<string>, digests array<string>"))
    chunks = cut.select(F.explode(F.arrays_zip("hashes", "digests")).alias("c")).select("c.hashes", "c.digests")
    several = chunks.groupBy("hashes").agg(F.min("digests").alias("a"), F.max("digests").alias("b")).filter("a != b")
    shared = [r["hashes"] for r in several.select("hashes").toLocalIterator()]
    name = lambda h, d: F.when(h.isin(shared), F.concat(h, d)).otherwise(h)
    return cut.select("id", "h", "sha", "size", F.zip_with("hashes", "digests", name).alias("recipe"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, h, keep_id, group_size, kept, sha``: one row per input row, groups by equal recipes.

    Of equal texts the row with the largest id stays; of rows that repeat id and text, one. Null
    counts as empty text; a group without any id keeps one row, whose id is null. Groups are
    counted before they are shuffled, and a group with a large share of all rows is dealt out
    over many tasks. An empty table gives no rows.
    """
    copies = recipes(docs, id_col, text_col).groupBy("recipe", "size", "id", "h", "sha").agg(F.count("*").alias("n"))
    copies = settle(copies)
    groups = settle(
        copies.groupBy("recipe", "size").agg(
            F.max("id").alias("keep_id"), F.sum("n").alias("group_size"), F.count("*").alias("listed")
        )
    )
    joined = join_groups(copies, groups, ["recipe", "size"], "listed", F.struct("id", "n"))
    return joined.select("*", F.posexplode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("i", "_copy")).select(
        "id", "h", "keep_id", "group_size", ((F.col("i") == 0) & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"), "sha"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """Of equal texts the document with the largest id stays, all columns as they were.

    Rows that repeat the id and text that stay are brought together, and one of them stays.
    """
    found = settle(exact_groups(docs))
    gone = found.groupBy("id", "h").agg(F.max("kept").alias("any"), F.count("*").alias("n"))
    left = drop_rows(docs, settle(gone.filter(~F.col("any")).select("id", "h")))
    again = settle(gone.filter(F.col("any") & (F.col("n") > 1)).select("id", "h"))
    if again.isEmpty():
        return left
    return drop_rows(left, again).unionByName(keep_rows(left, again).dropDuplicates(["doc_id", "text"]))
