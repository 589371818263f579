"""Nulls, empty tables, ties, repeated rows, long texts and clashing names, operator by operator."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from planted_documents import documents  # noqa: F401 - a fixture
from test_queries import slow_personal, slow_repeats

from matchcast.llm import chat, decontaminate, exact, langid, licenses, mixing, pii, repeats, simhash, warc
from matchcast.llm.common import join_groups, settle
from matchcast.llm.components import components

NULLS = [(1, None, "en", None), (None, "a b c", None, "s"), (2, "", "en", "s"), (1, None, "en", None), (None, None, None, None)]


def test_license_places_and_edges(documents):
    text = "Released under the MIT-License. CC BY cc by CC BY 4.0, gnu GENERAL public license!"
    rows = documents([(1, text), (1, text), (3, "x"), (4, "mit " * 3), (5, "word " * 50000 + "apache license"), *[n[:2] for n in NULLS]])
    found = licenses.license_scan(rows).collect()
    assert len(found) == 10
    one = [r for r in found if r.doc_id == 1 and r.n_words]
    assert len(one) == 2 and one[0] == one[1]
    assert (one[0].n_words, one[0].n_base, one[0].first_word, one[0].last_word) == (17, 5, 3, 13)
    assert one[0].base_labels == "cc-by,gpl,mit" and one[0].score == 1
    far = next(r for r in found if r.doc_id == 5)
    assert (far.n_words, far.first_word, far.labels) == (50002, 50000, "apache")
    empty = next(r for r in found if r.doc_id == 2)
    assert (empty.n_words, empty.n_base, empty.first_word, empty.labels, empty.score) == (0, 0, None, "", 0)
    assert licenses.license_scan(documents([])).count() == 0


def test_license_notice_with_a_gap(documents):
    notice = next(n for n, label in licenses.NOTICES.items() if label == "bsd").split()
    torn = " ".join(notice[:9] + ["really"] + notice[9:])
    r = licenses.license_scan(documents([(1, torn), (2, " ".join(notice[:6]))])).orderBy("doc_id").collect()
    assert (r[0].labels, r[0].base_labels, r[1].labels) == ("bsd", "", "")
    assert 0.8 <= r[0].score < 1


def test_license_plan_has_no_python(documents):
    plan = licenses.license_scan(documents([(1, "x")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan.split("== Physical Plan ==")[-1].split("Scan")[0])


def test_language_edges(documents):
    rows = [(i, "the cat and the dog " * 3, "en") for i in range(20)] + [(100 + i, "der hund und die katze " * 3, "de") for i in range(20)]
    rows += [(500, "the dog " * 200000), (501, None), (502, "12 34 !!"), (None, "die katze und der hund", "de"), (500, "the dog")]
    found = langid.identify(documents(rows)).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found if r.doc_id != 500}
    assert {r.lang_pred for r in found if r.doc_id == 500} == {"en"}
    assert (by[501].lang_pred, by[501].score, by[502].lang_pred, by[None].lang_pred) == ("und", 0, "und", "de")
    assert {r.lang_pred for r in langid.identify(documents([(1, "abc")])).collect()} == {"und"}
    assert langid.identify(documents([])).count() == 0


def test_language_pieces_change_nothing(documents, monkeypatch):
    model = langid.learn(documents([(1, "the cat sat on the mat", "en"), (3, "der hund lag auf dem dach", "de")]))
    texts = [b"the dog lay on the roof. " * 40, b"ein hund", b"", "é".encode()]
    whole = langid.score_texts(model, texts)
    monkeypatch.setattr(langid, "PIECE", 7)
    cut = langid.score_texts(model, texts)
    assert whole[0] == cut[0] and np.array_equal(whole[1], cut[1])


def test_decontamination_slots(spark, documents):
    items = spark.createDataFrame(
        [
            (7, "Bob has 5 apples and gives 2 pears to his sister, then walks 3 miles home with 5 apples."),
            (8, None), (9, "one two"), (7, "Bob has 5 apples and gives 2 pears to his sister, then walks 3 miles home with 5 apples."),
            (10, "short item of six words here"),
        ],
        "item_id long, text string",
    )
    body = "{} has {} apples and gives {} pears to his sister, then walks {} {} home with {} apples."
    rows = [
        (1, "Start here. " + body.format("Tom", 17, 4, 9, "miles", 17) + " End"),
        (2, body.format("Bob", 5, 2, 3, "miles", 5).upper()),
        (3, "nothing to see here, his sister walks home with apples"),
        (4, "so a SHORT, item of six words here."),
        (5, "x " * 300000 + body.format("Ann", 6, 6, 6, "km", 6)),
        *[n[:2] for n in NULLS],
    ]
    found = {(r.id, r.item): r for r in decontaminate.contaminated(documents(rows), items).collect()}
    assert set(found) == {(1, 7), (2, 7), (4, 10), (5, 7)}
    assert found[1, 7].changed and not found[2, 7].changed
    none = decontaminate.contaminated(documents([]), items)
    assert none.count() == 0
    assert decontaminate.contaminated(documents(rows), items.limit(0)).count() == 0


def test_decontamination_finds_literal_copies_of_any_item(spark, documents):
    texts = ["What is 12 + 7 - 3 * 45 / 9 + 88?", "Solve 3 x + 5 = 20 for x", "2 + 2", "one two", "17", "?!",
             "Add 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 and then give the sum of them to Bob"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    rows = [(10 + i, f"So here it is: {t} That was all.") for i, t in enumerate(texts)] + [(30, "What is 1 + 2 - 3 * 4 / 5 + 6?")]
    found = {(r.id, r.item): r.changed for r in decontaminate.contaminated(documents(rows), items).collect()}
    assert found == {(10, 0): False, (11, 1): False, (12, 2): False, (13, 3): False, (14, 4): False, (16, 6): False, (16, 4): False}


def test_decontamination_drops_torn_slots(spark, documents):
    item = "Take 5 stones then drop 5 stones then lift 5 stones then hide 5 stones"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    torn = item.replace("drop 5", "drop 6").replace("lift 5", "lift 7")
    rows = documents([(1, item.replace("5", "8")), (2, torn)])
    assert [r.id for r in decontaminate.contaminated(rows, items).collect()] == [1]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "'x' AS n")


def test_warc_round_trip(spark, tmp_path):
    long = "é" * 600
    rows = [(1, "http://a/%0D", long), (2, None, long), (5, "http://b\r\nX: y", long), (5, "u", long), (3, "v", "short"), (4, "w", "short")]
    rows += [(None, "n", long), (None, None, None), (9, "", "a\r\n\r\nb" * 400)]
    index = warc.write_archives(pages(spark, rows), f"file://{tmp_path}/w")
    found = warc.read_records(index).collect()
    assert Counter((r.page_id, r.url) for r in found) == Counter((p, u) for p, u, _ in rows)
    for r in found:
        html = next(h for p, u, h in rows if (p, u) == (r.page_id, r.url)) or ""
        whole = html.encode()
        assert (r.payload_bytes, r.payload_digest) == (len(whole), hashlib.sha1(whole).hexdigest())
        assert bytes(r.payload) == (whole if r.record_type == "response" else b"")
    kinds = Counter((r.page_id, r.record_type, r.refers_to) for r in found)
    assert kinds == Counter(
        [(1, "revisit", 5), (2, "revisit", 5), (5, "response", None), (5, "response", None), (3, "response", None),
         (4, "response", None), (None, "revisit", 5), (None, "response", None), (9, "response", None)]
    )
    some = warc.read_records(index.filter("page_id = 9")).collect()
    assert [bytes(r.payload) for r in some] == [b"a\r\n\r\nb" * 400]
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_warc_ranges_are_joined():
    entries = [("a", 0, 10), ("a", 10, 10), ("a", 20 + warc.GAP, 5), ("a", 26 + 2 * warc.GAP, 5), ("b", 0, warc.RANGE_BYTES + 1), ("b", warc.RANGE_BYTES + 1, 1)]
    found = list(warc._ranges(entries))
    assert [(a, o, n) for a, o, n, _ in found] == [
        ("a", 0, 25 + warc.GAP), ("a", 26 + 2 * warc.GAP, 5), ("b", 0, warc.RANGE_BYTES + 1), ("b", warc.RANGE_BYTES + 1, 1)
    ]


def test_simhash_edges(documents):
    same = "one two three four five six seven"
    rows = [(9, same), (4, same.upper()), (4, same), (7, None), (8, " \t\n"), (None, same), (None, None), (3, "one two"), (3, "ONE  two"), (5, "w " * 200000)]
    found = Counter((r.id, r.root) for r in simhash.near_duplicates(documents(rows)).collect())
    assert found == Counter([(9, 4), (4, 4), (4, 4), (7, 7), (8, 7), (None, 4), (None, 7), (3, 3), (3, 3), (5, 5)])
    assert simhash.near_duplicates(documents([])).count() == 0
    only = simhash.near_duplicates(documents([(None, "a b c d")])).collect()
    assert [(r.id, r.root) for r in only] == [(None, None)]


def test_similar_texts_meet_and_others_do_not(documents):
    rng = random.Random(21)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows, like = [], {}
    for g in range(40):
        base = [rng.choice(vocabulary) for _ in range(300)]
        rows.append((g * 10, " ".join(base)))
        for k in range(1, 4):
            other = list(base)
            for _ in range(k):
                other[rng.randrange(300)] = rng.choice(vocabulary)
            rows.append((g * 10 + k, " ".join(other).upper()))
        half = base[:150] + [rng.choice(vocabulary) for _ in range(150)]
        rows.append((g * 10 + 5, " ".join(half)))
        like |= {g * 10 + k: g * 10 for k in range(4)} | {g * 10 + 5: g * 10 + 5}
    found = {r.id: r.root for r in simhash.similar_documents(documents(rows)).collect()}
    assert found == like
    assert simhash.similar_documents(documents([])).count() == 0
    kept = simhash.keep_first(documents([*rows, (None, None), (None, rows[0][1])]))
    assert {r.doc_id for r in kept.collect()} == {*like.values(), None}


def test_many_similar_texts_are_one_group(documents):
    rng = random.Random(22)
    base = [rng.choice("abcdefghijklmnop") * rng.randrange(1, 9) for _ in range(200)]
    rows = []
    for i in range(700):
        text = list(base)
        text[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(text)))
    rows += [(1000 + i, " ".join(rng.choice("qrstuvwxyz") * rng.randrange(1, 9) for _ in range(200))) for i in range(30)]
    found = [r.root for r in simhash.similar_documents(documents(rows)).collect()]
    assert Counter(found)[0] == 700 and len(set(found)) == 31


def jaccard(x, y):
    x, y = (set(zip(*(t.lower().split()[i:] for i in range(5)))) for t in (x, y))
    return len(x & y) / len(x | y)


def test_similar_texts_are_brute_force(documents):
    rng = random.Random(31)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, like = [], {}
    for g in range(150):
        base = [rng.choice(vocabulary) for _ in range(200)]
        other = list(base)
        for k in rng.sample(range(0, 195, 5), rng.randrange(2, 7)):
            other[k] = rng.choice(vocabulary)
        pair = " ".join(base), " ".join(other)
        rows += [(2 * g, pair[0]), (2 * g + 1, pair[1])]
        like |= {2 * g: 2 * g, 2 * g + 1: 2 * g + (jaccard(*pair) < 0.8)}
    assert 40 < sum(i % 2 and like[i] < i for i in like) < 140
    assert {r.id: r.root for r in simhash.similar_documents(documents(rows)).collect()} == like


def test_the_pipeline_links_by_fingerprints_and_by_sets(documents):
    tail = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    often = "a b c " * 100
    texts = {1: often + tail("x", 20), 2: "a b c a b c " + tail("y", 60), 3: often + tail("y", 60), 4: tail("z", 80), 5: often + tail("u", 20)}
    bits = lambda i, j: (simhash.fingerprint(texts[i].encode()) ^ simhash.fingerprint(texts[j].encode())).bit_count()
    assert bits(1, 3) <= 2 and bits(1, 5) <= 2 < min(bits(2, 3), bits(1, 2), bits(1, 4), bits(2, 4))
    assert jaccard(texts[2], texts[3]) >= 0.8 > max(jaccard(texts[1], texts[i]) for i in (2, 3, 4, 5))
    rows = [*texts.items(), (None, texts[5]), (None, tail("v", 30))]
    kept = simhash.keep_first(documents(rows)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, rows[-1][1]), (1, texts[1]), (4, texts[4])]


def test_likes_meet_among_very_many_unlike_texts(documents):
    rng = random.Random(33)
    shared = " ".join(f"b{i}" for i in range(84))
    own = lambda n: " ".join(f"o{rng.randrange(10**9)}" for _ in range(n))
    rows = [(i, f"{shared} {own(24)}") for i in range(10400)] + [(20000 + i, f"{shared} {own(3)}") for i in range(12)]
    assert jaccard(rows[0][1], rows[1][1]) < 0.65 and jaccard(rows[0][1], rows[-1][1]) < 0.78 and jaccard(rows[-2][1], rows[-1][1]) > 0.9
    found = {r.id: r.root for r in simhash.similar_documents(documents(rows)).collect()}
    assert found == {i: min(i, 20000) for i, _ in rows}


def test_one_document_in_several_rows_is_one(documents):
    rows = [(5, "a b c d e f"), (5, "u v w x y z"), (2, "a b c d e f"), (3, "u v w x y z"), (9, "m n o p q r")]
    assert {(r.id, r.root) for r in simhash.near_duplicates(documents(rows)).collect()} == {(5, 2), (2, 2), (3, 2), (9, 9)}


def test_links_join_all_within_distance(spark):
    rng = random.Random(4)
    fps = [rng.getrandbits(64) for _ in range(40)]
    fps += [f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for f in fps for _ in range(3)]
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    near = {(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    found = {(r.fa, r.fb) for r in simhash.fingerprint_links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()}
    assert found <= near
    assert groups(fps, found) == groups(fps, near)
    with pytest.raises(ValueError):
        simhash.fingerprint_links(spark.range(0).selectExpr("id AS fp"), 3)


def groups(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 501 + i) for i in range(300)] + [(7, 7), (8, 9), (9, 8), (8, 9)]
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    rng.shuffle(edges)
    nodes = {n for e in edges for n in e} - {7}
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = groups(nodes, [e for e in edges if e[0] != e[1]])
    loops = {a for a, b in edges if a == b}
    touched = {n for e in edges if e[0] != e[1] for n in e}
    assert found == {n: r for n, r in expected.items() if n in touched or n not in loops}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_edges(documents):
    long = "".join(random.Random(2).choice("abcdef ") for _ in range(300000))
    rows = [(3, long), (8, long), (5, long + "!"), (8, long), (1, "x"), (None, "x"), (2, None), (4, ""), (None, "only"), (None, "only")]
    found = exact.exact_groups(documents(rows)).collect()
    assert Counter((r.id, r.keep_id, r.group_size, r.kept) for r in found) == Counter(
        [(3, 8, 3, False), (8, 8, 3, True), (8, 8, 3, False), (5, 5, 1, True), (1, 1, 2, True), (None, 1, 2, False),
         (2, 4, 2, False), (4, 4, 2, True), (None, None, 2, True), (None, None, 2, False)]
    )
    assert {r.sha for r in found if r.id == 3} == {hashlib.sha256(long.encode()).hexdigest()}
    assert exact.exact_groups(documents([])).count() == 0
    kept = exact.keep_one(documents(rows))
    assert kept.columns == documents([]).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([8, 5, 1, 4, None])


def test_colliding_chunks_are_told_apart(documents, monkeypatch):
    monkeypatch.setattr(exact.xxhash, "xxh64_hexdigest", lambda c: "0" * 16)
    monkeypatch.setattr(exact, "_recipes", exact._recipes)
    texts = documents([(1, "aaaa"), (2, "bbbb"), (3, "aaaa")])
    found = {r.id: r.keep_id for r in exact.exact_groups(texts).collect()}
    assert found == {1: 3, 2: 2, 3: 3}


def test_chunks_are_whole_and_stable():
    rng = np.random.default_rng(3)
    text = rng.integers(97, 123, 50000, dtype=np.uint8).tobytes()
    ends = exact.chunk_ends(text)
    assert ends[-1] == len(text) and ends == sorted(set(ends)) and len(ends) > 10
    moved = exact.chunk_ends(text[:10000] + b"inserted" + text[10000:])
    assert len({e - 8 for e in moved} & set(ends)) > len(ends) / 2
    assert exact.chunk_ends(b"") == [] and exact.chunk_ends(b"a") == [1]


def test_repeats_with_small_windows(documents, monkeypatch):
    rng = random.Random(3)
    draw = lambda n, chars: "".join(rng.choice(chars) for _ in range(n))
    pool = [draw(rng.randint(20, 90), "ab") for _ in range(15)] + ["x" * 150, "ab" * 80]
    texts = ["".join(rng.choice(pool) + draw(rng.randint(0, 4), "abc") for _ in range(rng.randint(0, 7))) for _ in range(120)]
    texts += [None, "", texts[3], texts[3], draw(5000, "abcdefgh") + pool[0]]
    monkeypatch.setattr(repeats, "PIECE", 1 << 20)
    rows = [(None if i == 7 else i % 90, t) for i, t in enumerate(texts)]
    found = repeats.repeated_bytes(documents(rows), length=40, gram=20).collect()
    expected = Counter(zip([r[0] for r in rows], slow_repeats([(t or "").encode() for t in texts], 40)))
    assert Counter((r.id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in found) == expected
    assert repeats.repeated_bytes(documents([])).count() == 0


def test_sampling_does_not_depend_on_pieces():
    rng = np.random.default_rng(5)
    text = rng.integers(97, 100, 3000, dtype=np.uint8).tobytes()

    def windows(size):
        old, repeats.PIECE = repeats.PIECE, size
        found = {}
        for data, valid, _, offset in repeats._text_pieces([text], 40):
            core, _, first, count = repeats.sampled(data, valid, 40, 20)
            found |= {int(offset[f]) + i: int(c) for c, f, n in zip(core, first, count) for i in range(n)}
        repeats.PIECE = old
        return found

    assert windows(1 << 20) == windows(100) and len(windows(100)) == 2961


def test_chat_edges(spark):
    odd = f"{chat.ESCAPE}1 <s></s>[INST][/INST] é\n"
    rows = [(1, 1, "assistant", odd), (1, 0, "user", odd), (2, None, None, None), (None, 0, "assistant", "x"), (3, 0, "assistant", ""), (3, 0, "assistant", "a"), (3, 0, "assistant", "a")]
    rows += [(4, i, "assistant" if i % 2 else "user", "wörd " * 2000) for i in range(40)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS formatted")
    found = {r.conv_id: r for r in chat.read_back(chat.format_chats(table)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert found[1].turns_sha256 == sha(f"user\n{odd}\nassistant\n{odd}\n") and found[1].loss_sha256 == sha(odd)
    assert (found[2].n_turns, found[2].turns_sha256, found[2].loss_chars) == (1, sha("\n\n"), 0)
    assert found[None].loss_sha256 == sha("x") and found[3].loss_sha256 == sha("aa") and found[3].n_turns == 3
    assert found[4].loss_chars == 20 * 10000
    assert chat.read_back(chat.format_chats(table.limit(0))).count() == 0


def test_escape_is_reversible_and_leaves_no_control():
    rng = random.Random(6)
    parts = [*chat.CONTROL, chat.ESCAPE, "0", "1", "<", "s", ">", "/", "[", "INST", "]", "é"]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(12))
        hidden = chat.escape(text)
        assert chat.unescape(hidden) == text and not any(c in hidden for c in chat.CONTROL)


def test_masks_are_the_overlap():
    offsets = np.array([(0, 3), (3, 5), (5, 6), (5, 6), (6, 9), (9, 12)])
    found = chat.intersect(offsets, np.array([(4, 6), (10, 12)]))
    assert found.tolist() == [[0, 0], [4, 5], [5, 6], [5, 6], [0, 0], [10, 12]]
    assert chat.intersect(offsets, np.zeros((0, 2), int)).sum() == 0


def test_personal_patterns_on_noise():
    rng = random.Random(5)
    texts = ["".join(rng.choice("a1.@+- 5(é%") for _ in range(150)) for _ in range(1500)] + ["1" * 5000, "a" * 5000 + "@", "+1" + "(" * 5000]
    assert all(pii.base_spans(t) == slow_personal(t) for t in texts)


def test_network_gradient_is_right():
    net = pii.Network.new(1)
    for k in net.w:
        net.w[k] = net.w[k].astype(np.float64)
    rng = np.random.default_rng(2)
    ids, tags = rng.integers(1, pii.VOCABULARY, (6, 3)), rng.integers(0, pii.TAGS, (6, 3))

    def loss():
        e, _ = net.emissions(ids)
        z = net.marginals(e)[2]
        gold = net.w["s"][tags[0]] + sum(e[t, range(3), tags[t]] for t in range(6)) + 0
        emit_first = 0
        path = gold + emit_first + sum(net.w["t"][tags[t - 1], tags[t]] for t in range(1, 6))
        return float((z - path).mean())

    grads = net.gradients(ids, tags)
    for name, at in (("o", (3, 2)), ("t", (1, 2)), ("s", (4,)), ("c", (1,)), ("hf", (2, 5)), ("hb", (1, 40)), ("xf", (ids[2, 1], 3)), ("xb", (ids[0, 0], 50))):
        old = net.w[name][at]
        net.w[name][at] = old + 1e-4
        up = loss()
        net.w[name][at] = old - 1e-4
        down = loss()
        net.w[name][at] = old
        assert grads[name][at] == pytest.approx((up - down) / 2e-4, rel=2e-2, abs=2e-4), name


def test_network_learns_and_adds(documents):
    rng = random.Random(8)
    words = "the of and to in that is was for on".split()
    say = lambda: " ".join(rng.choice(words) for _ in range(12))
    made = lambda: f"{rng.choice(words)}{rng.randrange(99)}@mail{rng.randrange(9)}.example.com"
    texts = [f"{say()} {made()} {say()}" for _ in range(150)] + [f"{say()} version {rng.randrange(9)} {say()}" for _ in range(80)]
    windows, tags = [], []
    for t in texts:
        for s in pii.window_starts(t):
            windows.append(pii._encode(t, s))
            tags.append(pii._tags(pii.base_spans(t), s))
    net = pii.train(np.array(windows), np.array(tags))
    fresh = [f"{say()} {made()} {say()}" for _ in range(40)]
    alone = pii.added_spans(net, fresh, [[] for _ in fresh])
    hits = sum(b in a for t, a in zip(fresh, alone) for b in pii.base_spans(t))
    assert hits >= 30
    known = [pii.base_spans(t) for t in fresh]
    assert not any(a < y and x < b for k, m in zip(known, pii.added_spans(net, fresh, known)) for a, _, b in m for x, _, y in k)
    assert pii.train(np.zeros((0, 64), int), np.zeros((0, 64), int)) is None


def test_personal_edges(documents):
    rows = [n[:2] for n in NULLS] + [(9, "z " * 300000 + "a@b.cd"), (9, "1.2.3.4")]
    found = pii.personal_data(documents(rows)).collect()
    assert len(found) == 7 and {r.spans for r in found if r.id == 9} == {"email:600000:600006", "ip:0:7"}
    assert next(r for r in found if r.id == 2).base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.personal_data(documents([])).count() == 0


def slow_targets(sizes, weights, total, most):
    targets, free = [0.0] * len(sizes), set(range(len(sizes)))
    left = total
    while free:
        weight = sum(weights[i] for i in free)
        over = {i for i in free if left * weights[i] / weight > most * sizes[i]}
        for i in free:
            targets[i] = left * weights[i] / weight
        if not over:
            break
        for i in over:
            targets[i] = float(most * sizes[i])
        left -= sum(targets[i] for i in over)
        free -= over
    return targets


def test_targets_are_reshared():
    rng = random.Random(3)
    for _ in range(300):
        sizes = [rng.choice([0, 1, 5, 100, rng.randrange(2000)]) for _ in range(rng.randrange(1, 9))]
        weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
        found = mixing.water_level(sizes, weights, 1.5 * sum(sizes), 2)
        assert found == pytest.approx(slow_targets(sizes, weights, 1.5 * sum(sizes), 2))


def test_mix_comes_near_its_targets(documents):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randrange(40), None, rng.choice(["a", "b", "é", None, "a", "a"])) for i in range(1500)]
    rows += [(2000, "w " * 30000, None, "a"), (2001, None, None, "z"), (2001, None, None, "z"), (None, "w w", None, None)]
    found = mixing.mix(documents(rows), shards=8).collect()
    assert len(found) == len(rows)
    by = {}
    for r in found:
        assert r.taken == r.copies * r.size <= 2 * r.size and len(r.shards) == r.copies
        assert all(s is not None and 0 <= s < 8 for s in r.shards)
        by.setdefault((r.target, r.source_size), []).append(r)
    for (target, _), group in by.items():
        assert abs(sum(r.taken for r in group) - target) <= max(r.size for r in group) / 2 + 1
    again = mixing.mix(documents(rows[::-1]).repartition(5), shards=8).collect()
    assert Counter((r.id, r.taken, tuple(r.shards)) for r in again) == Counter((r.id, r.taken, tuple(r.shards)) for r in found)
    assert mixing.mix(documents([])).count() == 0


def test_tree_deals_exact_quotas():
    quotas = np.array([1000, 37, 0, 512])
    dealt = mixing.split_tree(quotas, 10, 1)
    assert dealt.sum(axis=0).tolist() == quotas.tolist()
    assert dealt.sum(axis=1).max() - dealt.sum(axis=1).min() <= 1


def test_written_mix_has_each_copy(documents):
    rows = [(i, "w " * (i % 7), None, "ab"[i % 2]) for i in range(200)]
    docs = documents(rows)
    plan = {r.id: r.copies for r in mixing.mix(docs).collect()}
    written = mixing.write_order(docs)
    assert written.columns == [*docs.columns, "mix_copy", "mix_shard", "mix_order"]
    found = written.collect()
    assert Counter(r.doc_id for r in found) == Counter({d: n for d, n in plan.items() if n})
    assert len({r.mix_order for r in found}) == len(found)


def test_groups_are_joined_whole_with_a_hot_one(spark):
    rows = spark.range(5000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id")
    groups_ = settle(rows.groupBy("k").count())
    joined = join_groups(rows, groups_, ["k"], "count", rows["id"])
    assert joined.count() == 5000 and joined.filter("k = 0 AND count != 1667").count() == 0
