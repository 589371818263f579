"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchcast.llm.common import byte_texts, map_arrow, out_batch

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SCALE = 1 << 14  # log-probabilities are whole numbers of 1/SCALE, so sums do not depend on their order
SAMPLE = 3000  # documents a language is learned from, in expectation
PIECE = 1 << 18  # code points that are scored at a time
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    """``weights[bucket, language]`` and ``prior[language]``, in 1/SCALE of a nat."""

    languages: tuple[str, ...]
    weights: np.ndarray
    prior: np.ndarray


@functools.cache
def _folding() -> np.ndarray:
    """For each code point its lower-case letter, or a blank for what is no letter."""
    out = np.full(0x110000, 0x20, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def _letters(text: bytes) -> np.ndarray:
    """A text's letters in lower case; each run of other characters is one blank, also at both ends."""
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    folded = np.concatenate(([0x20], _folding()[points], [0x20])).astype(np.uint64)
    blank = folded == 0x20
    return folded[np.concatenate(([True], ~(blank[1:] & blank[:-1])))]


def _grams(letters: np.ndarray, order: int) -> np.ndarray:
    """The bucket of each n-gram of one order."""
    if len(letters) < order:
        return np.zeros(0, np.int64)
    h = np.full(len(letters) - order + 1, order, np.uint64)
    for k in range(order):
        h = (h * np.uint64(0x100000001B3)) ^ letters[k : len(letters) - order + 1 + k]
    h *= np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _gram_rows(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(row, buckets) for pieces of each text that has a letter; pieces overlap so that no n-gram is lost or doubled."""
    for row, text in enumerate(texts):
        letters = _letters(text)
        if len(letters) < 2:  # one blank: no letter
            continue
        for start in range(0, len(letters), PIECE):
            yield row, np.concatenate([_grams(letters[start : start + PIECE + n - 1], n) for n in ORDERS])


def _count_grams(batches):
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for row, buckets in _gram_rows(byte_texts(batch.column("text"))):
            counts = held.setdefault(langs[row], np.zeros(BUCKETS, np.int64))
            counts += np.bincount(buckets, minlength=BUCKETS)
    for lang, counts in held.items():
        at = np.flatnonzero(counts)
        yield out_batch(schema, ([lang] * len(at), at, counts[at]))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def learn(labelled: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", sample: int = SAMPLE) -> LanguageModel:
    """Count n-grams of a sample of about ``sample`` documents a language; all if it has fewer.

    Which documents are taken follows from a hash of the id. Rows without a language are not used. Only
    the counts of a language's buckets come to the driver, at most ``BUCKETS`` a language.
    """
    rows = labelled.filter(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        return LanguageModel((), np.zeros((BUCKETS, 0), np.int32), np.zeros(0, np.int64))
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, sample / sizes[lang]))])
    drawn = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    taken = rows.filter(drawn < share[F.col("lang")]).select("text", "lang")
    counted = map_arrow(taken, _count_grams, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.ones((BUCKETS, len(languages)))
    index = {lang: i for i, lang in enumerate(languages)}
    for r in counted.toLocalIterator():
        counts[r["bucket"], index[r["lang"]]] += r["n"]
    weights = np.log(counts / counts.sum(axis=0))
    prior = np.log(np.array([sizes[lang] for lang in languages]) / sum(sizes.values()))
    return LanguageModel(languages, np.rint(weights * SCALE).astype(np.int32), np.rint(prior * SCALE).astype(np.int64))


def score_texts(model: LanguageModel, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its posterior probability; ``und`` without a letter.

    A batch is a sparse matrix, a row a text and an entry an n-gram; its product with the weights
    is a sum over each text's stretch of gathered weights.
    """
    totals = np.zeros((len(texts), len(model.languages)), np.int64)
    seen = np.zeros(len(texts), bool)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    rows, parts, held = [], [], 0

    def flush() -> None:
        nonlocal rows, parts, held
        if parts:
            starts = np.concatenate(([0], np.cumsum([len(p) for p in parts])[:-1]))
            sums = np.add.reduceat(model.weights[np.concatenate(parts)], starts, axis=0, dtype=np.int64)
            np.add.at(totals, rows, sums)
        rows, parts, held = [], [], 0

    for row, buckets in _gram_rows(texts):
        seen[row] = True
        rows.append(row)
        parts.append(buckets)
        held += len(buckets)
        if held >= PIECE:
            flush()
    flush()
    ll = (totals + model.prior) / SCALE
    best = ll.argmax(axis=1)
    score = 1 / np.exp(ll - ll.max(axis=1, keepdims=True)).sum(axis=1)
    return [model.languages[b] if s else UNKNOWN for b, s in zip(best, seen)], np.where(seen, score, 0.0)


def predict(docs: DataFrame, model: LanguageModel, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """``id_cols, lang_pred, score`` for every row; only the text decides.

    Null texts and texts without a letter are ``und`` with score 0, as all are if no language
    was learned. Texts are read whole, in pieces of bounded size. The matrix is broadcast: its
    size is ``BUCKETS`` x languages x 4 bytes.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(*id_cols, F.col(text_col).alias("_text"))
    schema = rows.drop("_text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def score(batches):
        for batch in batches:
            names, scores = score_texts(shared.value, byte_texts(batch.column("_text")))
            columns = [batch.column(c) for c in id_cols]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*id_cols, "lang_pred", "score"]
            )

    return map_arrow(rows, score, schema)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Learn from the labelled rows that are not held out, then predict all: ``doc_id, held_out, lang_pred, score``."""
    model = learn(docs.filter(~held_out()), sample=sample)
    return predict(docs.select("doc_id", "text"), model, ["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose language is told with a probability of ``least`` or more, all columns as they were."""
    model = learn(docs.filter(~held_out()))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def keep(batches):
        for batch in batches:
            langs, scores = score_texts(shared.value, byte_texts(batch.column(names.index("text"))))
            yield batch.filter(pa.array([lang != UNKNOWN and s >= least for lang, s in zip(langs, scores)], pa.bool_()))

    return map_arrow(docs, keep, docs.schema)
