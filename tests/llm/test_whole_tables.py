"""Larger cases: a very long text, copies without ids, and the draws of a mix."""

import numpy as np
from planted_documents import documents  # noqa: F401 - a fixture

from matchcast.llm import licenses, mixing, repeats


def test_copies_of_one_id_and_text(documents):
    text = "".join(chr(97 + i * i % 23) for i in range(900))
    rows = [(None, text)] * 300 + [(1, text[:500]), (1, text[:500]), (2, "alone " * 10)]
    found = repeats.repeated_bytes(documents(rows)).collect()
    assert sorted((r.n_removed, r.n_spans) for r in found) == [(0, 0)] + [(500, 1)] * 2 + [(900, 1)] * 300


def test_a_license_in_a_million_words(documents):
    long = "word other " * 500_000 + "mit license " + "word " * 1000
    found = licenses.license_scan(documents([(1, long), (2, "mit license")])).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_base, r.first_word, r.base_labels) for r in found] == [(1_001_002, 1, 1_000_000, "mit"), (2, 1, 0, "mit")]


def test_what_is_taken_is_what_the_outputs_drew(spark, documents):
    rows = [(i, "w " * (1 + i % 7), "en", ["a", "b", None][i % 3]) for i in range(3000)]
    rows += [(None, f"no id {i}", "en", "a") for i in range(900)] + [(5, f"again {i}", "en", "b") for i in range(300)]
    found = mixing.mix(documents(rows)).collect()
    assert all(r.taken == r.size * len(r.shards) and r.copies == len(r.shards) for r in found)
    by_source = {}
    for r in found:
        have = by_source.setdefault(r.target, [r.source_size, 0])
        have[1] += r.taken
    for target, (size, taken) in by_source.items():
        assert abs(taken - target) <= 7, (target, size, taken)  # rows without an id, or with one that repeats, are told apart
    quotas = [mixing.Quota("a", 100, 150.0, 1, 50.0, "7ff"), mixing.Quota("b", 10, 0.0, 0, 0.0, "")]
    drawn = np.array([256 + mixing._blocks_below("7ff"), 0])
    dealt = mixing.split_tree(drawn, 8, 7)
    taken = [(block, shard, cut) for key, block, outputs in mixing.draws(quotas, dealt) for shard, cut in outputs]
    assert len(taken) == 384 and {key for key, _, _ in mixing.draws(quotas, dealt)} == {"+a"}
    assert [sum(s == i for _, s, _ in taken) for i in range(8)] == dealt[:, 0].tolist()
    assert sum(cut == "g" for *_, cut in taken) == 256
    assert spark.createDataFrame(mixing.draws(quotas, dealt), "key string, block int, outputs array<struct<shard:int,cut:string>>").count() == 256
