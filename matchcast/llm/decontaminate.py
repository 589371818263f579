"""Benchmark decontamination by canonical templates: windows of typed placeholders, joined by hash."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchcast.llm.common import byte_texts, drop_rows, map_arrow, settle, text_hash

WINDOW = 8  # canonical words of a window
LEAST_ITEM = 5  # items with fewer words are searched for literally
LITERAL = 5 / 8  # share of a window with placeholders that is none
ENOUGH = 13  # words of an item that must be covered,
SHARE = 0.8  # or this share of a shorter item
FILTER_BITS = 1 << 23  # of the filter that is sent to the scans: 1 MB, whatever the benchmark's size
PIECE = 1 << 18  # bytes that are cut into words at a time

# Words that after a number are a unit, and given names that count wherever they stand.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons ounce ounces pound pounds ml l liter liters "
    "litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years "
    "mph kmh percent degrees celsius fahrenheit cent cents dollar dollars euro euros usd eur joule joules watt watts volt volts"
).split()
NAMES = (
    "alice bob carol dave eve mary john james robert michael william david richard joseph thomas charles sarah susan "
    "jessica karen lisa nancy emma olivia noah liam sophia anna maria peter paul tom jane janet natalia weng betty julie"
).split()

WORD, NUMBER, UNIT, NAME = range(4)
MARKS = {NUMBER: b"<n>", UNIT: b"<u>", NAME: b"<m>"}
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_DIGIT = _table(b"0123456789")
_LETTER = _table(b"abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))
_STOP = _table(b".!?\n:;\"|\x00")
_INNER = _table(b".,")


@dataclass
class Words:
    """The words of several texts: places in ``folded``, the text's number, hash and kind."""

    folded: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    kind: np.ndarray

    def raw(self, i: int) -> bytes:
        return self.folded[self.start[i] : self.end[i]].tobytes()


_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers; kept, as pieces of text are about equally long."""
    if len(_powers.get(base, ())) < n:
        out = np.full(max(n, PIECE + PIECE // 4), base, np.uint64)
        out[0] = 1
        _powers[base] = np.multiply.accumulate(out)
    return _powers[base][:n]


def _word_hashes(folded: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes, from sums of all bytes times powers of an odd number."""
    sums = np.zeros(len(folded) + 1, np.uint64)
    np.cumsum(folded * _powers_of(_BASE, len(folded)), dtype=np.uint64, out=sums[1:])
    h = (sums[end] - sums[start]) * _powers_of(_INVERSE, len(folded))[start]
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


def _listed(words: list[str]) -> np.ndarray:
    data = np.frombuffer("\x00".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    return _word_hashes(data, np.concatenate(([0], ends[:-1] + 1)), ends)


def cut_words(texts: list[bytes]) -> Words:
    """Words are runs of letters or of digits (with points and commas inside), in lower case.

    Letters are a-z and all that is not ASCII; A-Z and the capitals of Latin-1 are lower-cased. A number is
    a run of digits; a unit a listed word after a number; a name a listed word, or any word with
    one capital that does not begin a sentence.
    """
    data = np.frombuffer(b"\x00".join(texts) + b"\x00", np.uint8)
    after_c3 = np.concatenate(([False], data[:-1] == 0xC3))
    capital = ((data >= 65) & (data <= 90)) | (after_c3 & (data >= 0x80) & (data <= 0x9E) & (data != 0x97))
    folded = data + (capital * np.uint8(32))
    digit = _DIGIT[folded]
    inner = _INNER[folded]
    inner[1:-1] &= digit[:-2] & digit[2:]
    kinds = np.where(digit | inner, 1, np.where(_LETTER[folded], 2, 0)).astype(np.int8)
    edge = np.concatenate(([0], kinds[:-1])) != kinds
    start = np.flatnonzero(edge & (kinds != 0))
    end = np.flatnonzero(np.concatenate((edge[1:], [True])) & (kinds != 0)) + 1
    ends = np.cumsum([len(t) + 1 for t in texts])
    text = np.searchsorted(ends, start, "right")
    h = _word_hashes(folded, start, end)
    kind = np.zeros(len(start), np.int8)
    if len(start):
        number = kinds[start] == 1
        previous = np.concatenate(([False], (text[1:] == text[:-1])))
        kind[number] = NUMBER
        after = np.flatnonzero(number[:-1] & previous[1:]) + 1
        kind[after[np.isin(h[after], _listed(UNITS))]] = UNIT
        first = capital[start] | ((data[start] == 0xC3) & capital[np.minimum(start + 1, len(data) - 1)])
        titled = np.flatnonzero(first & (end - start > 1) & (kind == WORD))
        caps = np.concatenate(([0], np.cumsum(capital, dtype=np.int32)))
        titled = titled[caps[end[titled]] - caps[start[titled]] == 1]
        stops = np.concatenate(([0], np.cumsum(_STOP[data], dtype=np.int32)))
        inside = previous[titled] & (stops[start[titled]] == stops[end[titled - 1]])
        kind[titled[inside | np.isin(h[titled], _listed(NAMES))]] = NAME
    return Words(folded, start, end, text, h, kind)


def _windows(ids: np.ndarray, literal: np.ndarray, text: np.ndarray, size: int, at: np.ndarray) -> tuple:
    """Of the windows that begin ``at`` these words, those of one text with enough literal words, and their hashes."""
    sums = np.concatenate(([0], np.cumsum(literal, dtype=np.int32)))
    good = (text[at + size - 1] == text[at]) & (sums[at + size] - sums[at] >= int(np.ceil(LITERAL * size)))
    at = at[good]
    h = np.full(len(at), size, np.uint64)
    for k in range(size):
        h *= np.uint64(0xD6E8FEB86659FD93)
        h += ids[at + k]
    h ^= h >> np.uint64(31)
    return at, h


def template_windows(texts: list[bytes], sizes: list[int], wanted: np.ndarray | None) -> Iterator[tuple]:
    """``(text, place, size, gram, canon, slots)`` of each window, if the filter ``wanted`` has its hash.

    Windows come in three forms, where these differ: with names as placeholders, with names as words, and
    literally, numbers and units as words too. Shorter ones than ``LEAST_ITEM`` are literal alone. ``canon``
    is the window's text and ``slots`` what its placeholders stand for.
    """
    words = cut_words(texts)
    first = np.searchsorted(words.text, np.arange(len(texts)))
    unnamed = np.where(words.kind == NAME, WORD, words.kind)
    literal = np.zeros_like(words.kind)
    for kind, before in ((words.kind, None), (unnamed, words.kind), (literal, unnamed)):
        ids = np.where(kind == WORD, words.hash, kind.astype(np.uint64))
        turned = None if before is None else np.concatenate(([0], np.cumsum(kind != before, dtype=np.int32)))
        for size in sizes:
            if size < LEAST_ITEM and kind is not literal:
                continue
            at = np.arange(max(len(ids) - size + 1, 0))
            if turned is not None and size >= LEAST_ITEM:
                at = at[turned[at + size] > turned[at]]
            at, gram = _windows(ids, kind == WORD, words.text, size, at)
            if wanted is not None:
                bit = gram % np.uint64(FILTER_BITS)
                has = wanted[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1 > 0
                at, gram = at[has], gram[has]
            for i, g in zip(at.tolist(), gram.view(np.int64).tolist()):
                here = range(i, i + size)
                canon = b" ".join(words.raw(j) if kind[j] == WORD else MARKS[int(kind[j])] for j in here)
                slots = [words.raw(j).decode("utf-8", "replace") for j in here if kind[j] != WORD]
                t = int(words.text[i])
                yield t, i - int(first[t]), size, g, canon.decode("utf-8", "replace"), slots


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of whole texts of about ``PIECE`` bytes, with the number of the first."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= PIECE:
            yield first, texts[first : i + 1]
            first, held = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


WINDOW_COLUMNS = "place int, size int, gram long, canon string, slots array<string>"


def _scan(rows: DataFrame, sizes: list[int], wanted: np.ndarray | None) -> DataFrame:
    """The windows of ``rows(..., t)``, each with the other columns of its row."""
    names = [c for c in rows.columns if c != "t"]
    shared = None if wanted is None else rows.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        has = None if shared is None else shared.value
        for batch in batches:
            for first, texts in _pieces(byte_texts(batch.column("t"))):
                found = list(template_windows(texts, sizes, has))
                if found:
                    text, *rest = zip(*found)
                    kept = batch.select(names).take(pa.array([first + t for t in text], pa.int64()))
                    types = [pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.string())]
                    yield pa.RecordBatch.from_arrays(
                        [*kept.columns, *(pa.array(c, k) for c, k in zip(rest, types))],
                        [*names, "place", "size", "gram", "canon", "slots"],
                    )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "t")
    return map_arrow(rows, run, f"{fields}, {WINDOW_COLUMNS}")


def _window_filter(grams: DataFrame) -> np.ndarray:
    """A bit for each hash modulo ``FILTER_BITS``; at most ``FILTER_BITS / 64`` words come to the driver."""
    bit = F.col("gram").bitwiseAND(FILTER_BITS - 1)
    packed = grams.select(bit.alias("bit")).groupBy((F.col("bit") / 64).cast("long").alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits")
    )
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for r in packed.collect():
        out[r["at"]] = r["bits"]
    return out.view(np.uint8)


def _count_words(batches):
    for batch in batches:
        texts = byte_texts(batch.column("t"))
        counts = np.bincount(cut_words(texts).text, minlength=len(texts)) if texts else []
        yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("t"), pa.array(counts, pa.int32())], ["item", "t", "words"])


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text"
) -> DataFrame:
    """``id, h, item, covered, words, changed``: a row for each document and benchmark item it repeats.

    Windows of ``WINDOW`` canonical words (an item with fewer: all its words) are joined by hash and compared as text.
    Along one alignment each value of the item must become one value of the document wherever it
    stands; windows with values that do not are dropped. An item is repeated if the rest cover
    ``ENOUGH`` of its words, or ``SHARE`` of a shorter item. ``changed`` tells whether any value differs.

    Texts are read whole, in their own partitions; only windows that pass a filter of fixed size over
    the benchmark's windows are moved, and no window of the benchmark is lost by it. Null texts have
    no words, and items without words cannot be found. A literal copy of any other item is. ``h`` is the text's hash:
    rows that share an id are told apart by it, rows equal in both are one. Empty tables give no rows.
    """
    types = f"item {benchmark.schema[item_col].dataType.simpleString()}, t string, words int"
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("t"))
    counted = settle(map_arrow(items, _count_words, types).filter(F.col("words") > 0))
    sizes = sorted(r[0] for r in counted.select(F.least("words", F.lit(WINDOW))).distinct().collect())
    own = settle(_scan(counted, sizes, None).filter(F.col("size") == F.least("words", F.lit(WINDOW))))
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("h"), F.col(text_col).alias("t"))
    found = _scan(rows, sizes, _window_filter(own.select("gram")))

    theirs = own.select("item", "words", F.col("place").alias("at"), "gram", "canon", F.col("slots").alias("was")).distinct()
    met = found.join(theirs, ["gram", "canon"]).select(
        "id", "h", "item", "words", (F.col("place") - F.col("at")).alias("shift"), "at", "size",
        F.arrays_zip("was", F.col("slots").alias("now")).alias("pairs"),
    )
    met = settle(met.distinct())
    line = ["id", "h", "item", "words", "shift"]
    pairs = met.select(*line, F.explode("pairs").alias("p")).select(*line, "p.was", "p.now")
    torn = pairs.groupBy(*line, "was").agg(F.min("now").alias("a"), F.max("now").alias("b")).filter("a != b")
    torn = torn.groupBy(*line).agg(F.collect_set("was").alias("torn"))
    m, t = met.alias("m"), torn.alias("t")
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"t.{c}")) for c in line]
    held = m.join(t, same, "left").filter(~F.coalesce(F.arrays_overlap(F.col("m.pairs.was"), "t.torn"), F.lit(False)))
    values = F.exists("m.pairs", lambda p: p["was"] != p["now"])
    covered = held.select(*(f"m.{c}" for c in line[:4]), values.alias("changed"), F.explode(F.sequence(F.col("m.at"), F.col("m.at") + F.col("m.size") - 1)).alias("word"))
    counts = covered.groupBy(*line[:4], "word").agg(F.max("changed").alias("changed"))
    counts = counts.groupBy(*line[:4]).agg(F.count("*").cast("int").alias("covered"), F.max("changed").alias("changed"))
    enough = F.least(F.lit(ENOUGH), F.ceil(F.col("words") * F.lit(SHARE)).cast("int"))
    return counts.filter(F.col("covered") >= enough).select("id", "h", "item", "covered", "words", "changed")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that repeat no benchmark item, all columns as they were."""
    return drop_rows(docs, settle(contaminated(docs, benchmark).select("id", "h").distinct()))
