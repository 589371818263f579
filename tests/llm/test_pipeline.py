"""The pipeline's stages on planted cases, against decisions worked out by hand."""

import random
from collections import Counter

import pytest
from planted_documents import documents  # noqa: F401 - a fixture

import corpus_pipeline
from matchcast.llm import decontaminate, exact, langid, simhash

WORDS = {
    "en": "the house and garden were old but people there kept working every single day until night".split(),
    "de": "das haus und der garten waren alt aber die leute dort haben jeden tag gearbeitet".split(),
}


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "s", "en", "ly"]) for _ in range(n))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("planted")
    rng = random.Random(12)
    rows = [(i, prose(rng, lang, 120), lang, rng.choice("ab")) for i, lang in enumerate(["en", "de"] * 30)]
    item = prose(rng, "en", 30)
    long = prose(rng, "en", 900)
    near = long.split()
    near[450] = "changed"
    rows += [
        (100, "12 34 !! ??", "en", "a"), (101, None, "en", "a"), (102, "", None, None),
        (200, rows[3][1], "de", "b"), (201, rows[3][1], "de", "b"), (201, rows[3][1], "de", "b"),
        (300, long, "en", "a"), (301, " ".join(near), "en", "a"),
        (400, prose(rng, "en", 60) + " " + item.upper() + ". " + prose(rng, "en", 60), "en", None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "length(text) AS n_chars", "7 AS id", "8L AS h")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_drop_what_they_are_for(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    columns = docs.columns
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = Counter(r.doc_id for r in docs.collect())
        docs = stage(spark, docs, planted)
        assert docs.columns == columns, name
        after = Counter(r.doc_id for r in docs.collect())
        counts.append(sorted((before - after).elements()))
    assert counts == [[100, 101, 102], [3, 200, 201], [301], [400]]


def test_run_is_the_mix_of_what_is_left(spark, planted):
    found = corpus_pipeline.run(spark, planted).collect()
    ids = {r.doc_id for r in found}
    assert not ids & {100, 101, 102, 3, 200, 301, 400} and {201, 300} <= ids
    assert max(Counter(r.doc_id for r in found).values()) <= 2


def test_stages_stand_empty_tables(spark, planted, tmp_path):
    spark.read.parquet(f"{planted}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{planted}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_filters_keep_every_column(documents):
    docs = documents([(1, "a b c d e f", "en", "s"), (2, "a b c d e f", "en", "s"), (None, "g h i j k", "en", None)])
    for kept in (exact.keep_one(docs), simhash.keep_first(docs)):
        assert kept.columns == docs.columns and kept.count() == 2
    assert decontaminate.keep_clean(docs, docs.selectExpr("doc_id AS item_id", "text").limit(0)).count() == 3
    assert langid.keep_identified(docs).columns == docs.columns
