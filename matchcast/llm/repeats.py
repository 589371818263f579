"""Repeated byte strings: sampled suffixes of all shards, whose blocks are refined until every window is settled."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from matchcast.llm.common import HOT_SHARE, SALTS, byte_texts, join_groups, map_arrow, release, settle, text_hash

LENGTH = 400  # bytes of a string that must not stand twice
GRAM = 200  # bytes of a sampled suffix's first block
PIECE = 1 << 18  # windows that are looked at together
_PLACE = (1 << 21) - 1
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


@functools.cache
def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        x = np.full(_PLACE + 1, b, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


class Hashes:
    """Hashes of all substrings of at most 2**21 bytes, by sums of bytes times powers of an odd number."""

    def __init__(self, data: np.ndarray, base: int):
        powers, self.inverse = _powers(base)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * powers[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least value of each stretch of ``width``."""
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    padded = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(padded, axis=1).ravel()
    backward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def sampled(data: np.ndarray, valid: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """The sampled suffix of each window, by runs: ``core, run, first window, windows``.

    A window's suffix begins at the least of the hashes of its blocks of ``gram`` bytes, the leftmost of
    equals, so equal windows have the same one at the same place. ``core`` is that block's hash, ``run`` that
    of all bytes of a run of windows with one suffix, and of where the suffix stands in it.
    """
    at = np.flatnonzero(valid[: max(len(data) - length + 1, 0)])
    if not len(at):
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    hashes = Hashes(data, _BASES[0])
    starts = np.arange(len(data) - gram + 1)
    cores = hashes.of(starts, starts + gram)
    keyed = (cores & ~np.uint64(_PLACE)) | starts.astype(np.uint64)
    suffix = (_least(keyed, length - gram + 1)[at] & np.uint64(_PLACE)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (suffix[1:] != suffix[:-1]) | (at[1:] != at[:-1] + 1))))
    first, last = at[new], at[np.concatenate((new[1:], [len(at)])) - 1]
    suffix = suffix[new]
    run = hashes.of(first, last + length) + (suffix - first).astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    return cores[suffix], run, first, last - first + 1


def _text_pieces(texts: list[bytes], length: int) -> Iterator[tuple]:
    """``data, valid, text, offset``: short texts joined, a long one in pieces that share length - 1 bytes."""
    group: list[int] = []
    held = 0

    def joined():
        sizes = np.array([len(texts[i]) for i in group])
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(texts[i] for i in group), np.uint8)
        valid = np.repeat(ends, sizes) - np.arange(len(data)) >= length
        return data, valid, np.repeat(group, sizes), np.arange(len(data)) - np.repeat(ends - sizes, sizes)

    for i, t in enumerate(texts):
        if len(t) > PIECE:
            whole = np.frombuffer(t, np.uint8)
            for start in range(0, len(t) - length + 1, PIECE):
                data = whole[start : start + PIECE + length - 1]
                n = len(data)
                yield data, np.arange(n) <= n - length, np.full(n, i), np.arange(start, start + n)
        elif len(t) >= length:
            if held + len(t) > PIECE:
                yield joined()
                group, held = [], 0
            group.append(i)
            held += len(t)
    if group:
        yield joined()


def _scan(length: int, gram: int):
    def run(batches):
        for batch in batches:
            texts = byte_texts(batch.column("t"))
            for data, valid, text, offset in _text_pieces(texts, length):
                core, runs, first, count = sampled(data, valid, length, gram)
                rows = pa.array(text[first], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(rows), batch.column("h").take(rows), pa.array(core.view(np.int64)), pa.array(runs.view(np.int64)),
                     pa.array(offset[first], pa.int32()), pa.array(count, pa.int32())],
                    ["id", "h", "core", "run", "first", "windows"],
                )

    return run


def _hot(rows: DataFrame, keys: list[str], total: int) -> DataFrame:
    """The keys with over 1/1000 of all rows: less than 1000, so they can be broadcast."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > max(total // HOT_SHARE, 64))
    return settle(counts.select(*keys, F.lit(True).alias("hot")))


def _window_hashes(length: int):
    """Hashes of the windows of the runs that a text's list names."""

    def run(batches):
        for batch in batches:
            ids, hs, weight, core, place, windows = [], [], [], [], [], []
            for row, (text, runs) in enumerate(zip(byte_texts(batch.column("t")), batch.column("runs").to_pylist())):
                for r in runs:
                    data = np.frombuffer(text, np.uint8, r["windows"] + length - 1, r["first"])
                    at = np.arange(r["windows"])
                    windows.append(Hashes(data, _BASES[1]).of(at, at + length))
                    ids.append(np.full(len(at), row))
                    core.append(np.full(len(at), r["core"]))
                    place.append(at + r["first"])
                    weight.append(np.full(len(at), r["copies"]))
            if ids:
                rows = pa.array(np.concatenate(ids), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(rows), batch.column("h").take(rows), pa.array(np.concatenate(core)),
                     pa.array(np.concatenate(windows).view(np.int64)), pa.array(np.concatenate(place).astype(np.int32)),
                     pa.array(np.concatenate(weight).astype(np.int32))],
                    ["id", "h", "core", "window", "first", "copies"],
                )

    return run


def spans_of(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unite ranges that overlap or touch."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > ends[:-1]))
    return starts[new], ends[np.concatenate((np.flatnonzero(new)[1:], [len(starts)])) - 1]


def _removal(batches):
    for batch in batches:
        out = []
        for text, ranges in zip(byte_texts(batch.column("t")), batch.column("ranges").to_pylist()):
            digest, removed, spans, at = hashlib.sha256(), 0, 0, 0
            if ranges:
                found = np.array([(r["a"], r["b"]) for r in ranges], np.int64)
                for a, b in zip(*(x.tolist() for x in spans_of(found[:, 0], found[:, 1]))):
                    digest.update(text[at:a])
                    removed, spans, at = removed + b - a, spans + 1, b
            digest.update(text[at:])
            out.append((len(text), removed, spans, digest.hexdigest()))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        columns = [pa.array(list(c), k) for c, k in zip(zip(*out) if out else [[]] * 4, kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _with_lists(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    other = lists.select(F.col("id").alias("_id"), F.col("h").alias("_h"), *[c for c in lists.columns if c not in ("id", "h")])
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h"))
    return docs.join(other, same, how).drop("_id", "_h")


def _per_text(rows: DataFrame, *columns: Column, name: str) -> DataFrame:
    """The rows of a text as one list, which is no longer than the text, however many rows share its id and text."""
    return rows.groupBy("id", "h").agg(F.collect_set(F.struct(*columns)).alias(name))


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256``: one row per input row.

    Each byte that a string of ``length`` bytes covers which also starts elsewhere, in this text or another, is removed;
    strings are judged on the input. Rows that repeat are separate texts. Null texts are empty, and shorter ones
    than ``length`` keep all. An empty table gives no rows.

    Suffixes are sampled, so that every window of ``length`` bytes has one at a place only its bytes decide,
    and windows that share one lie in a block. A block of one run is settled at once, as are runs that
    stand more than once; other runs are refined to single windows, one of each run in place of its copies.
    Runs and blocks are counted before they are shuffled, and large ones dealt out over many tasks.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("h"), F.col(text_col).alias("t"))
    suffixes = settle(map_arrow(texts, _scan(length, gram), f"id {kind}, h long, core long, run long, first int, windows int"))

    lead = F.xxhash64("id", "h", "first")
    runs = settle(suffixes.groupBy("core", "run").agg(F.count("*").alias("copies"), F.min(lead).alias("lead")))
    blocks = runs.groupBy("core").agg(F.count("*").alias("runs"), F.sum("copies").alias("n"))
    blocks = settle(blocks.filter("n > 1").select("core", "runs", (F.col("runs") > 1).alias("mixed")))
    met = settle(join_groups(runs, blocks, ["core"], "runs", F.col("run"), "inner").drop("runs"))
    release(runs)
    judged = join_groups(suffixes, met, ["core", "run"], "copies", F.struct("id", "h", "first"), "inner")
    judged = settle(judged.select("id", "h", "core", "first", "windows", "copies", "mixed", (lead == F.col("lead")).alias("leads")))
    for done in (suffixes, blocks, met):
        release(done)

    open_runs = judged.filter("leads AND mixed")
    listed = _per_text(open_runs, F.col("first"), F.col("windows"), F.col("core"), F.least("copies", F.lit(2)).cast("int").alias("copies"), name="runs")
    opened = _with_lists(texts, listed, "inner").select("id", "h", "t", "runs")
    fields = f"id {kind}, h long, core long, window long, first int, copies int"
    windows = settle(map_arrow(opened, _window_hashes(length), fields))
    common = _hot(windows, ["core", "window"], windows.count())
    single = windows.join(F.broadcast(common), ["core", "window"], "left")
    twice = F.sum("copies").over(W.partitionBy("core", "window", F.when(F.col("hot"), F.pmod("first", F.lit(SALTS))).otherwise(F.lit(0)))) > 1
    again = single.withColumn("twice", twice).filter(F.col("hot").isNotNull() | F.col("twice"))

    whole = judged.filter("copies > 1").select("id", "h", F.col("first").alias("a"), (F.col("first") + F.col("windows") - 1 + length).alias("b"))
    parts = again.filter("copies = 1").select("id", "h", F.col("first").alias("a"), (F.col("first") + length).alias("b"))
    ranges = settle(_per_text(whole.unionByName(parts), F.col("a"), F.col("b"), name="ranges"))
    release(windows)
    done = _with_lists(texts, ranges, "left").select("id", "t", "ranges")
    return map_arrow(done, _removal, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
