"""Registered queries against SQL, and against brute force where SQL cannot express them."""

import hashlib
import re
from collections import Counter

import pandas as pd
import pytest
import xxhash
from conftest import SMALL
from oracle_check import connect, difference

from matchcast.llm import langid, pii
from matchcast.llm.oracle import ORACLE
from matchcast.llm.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SMALL}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    assert difference(QUERIES[name](spark, SMALL), duck, ORACLE[name]) is None


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def slow_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_is_brute_force(spark, docs):
    fps = {d: slow_fingerprint(t or "") for d, t in zip(docs.doc_id, docs.text)}
    root = {d: d for d in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 2 and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    rows = QUERIES["op5_simhash"](spark, SMALL).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in rows) == sorted((d, f"{fps[d]:016x}", find(d)) for d in fps)


def slow_repeats(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        yield len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()


def test_repeats_are_brute_force(spark, docs):
    expected = dict(zip(docs.doc_id, slow_repeats([(t or "").encode() for t in docs.text], 400)))
    rows = QUERIES["op7_repeats"](spark, SMALL).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == expected
    assert any(r.n_removed for r in rows)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def slow_personal(text):
    out = []
    for kind, (name, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0
            good = {
                "email": True,
                "ip": name == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn,
                "phone": 9 <= len(digits) <= 15,
            }
            if good[name]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_personal_data_keeps_the_base(spark, docs):
    rows = {r.doc_id: r for r in QUERIES["op9_pii"](spark, SMALL).collect()}
    assert len(rows) == len(docs)
    for d, t in zip(docs.doc_id, docs.text):
        base = slow_personal(t or "")
        r = rows[d]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert set(pii.joined(base).split(",")) <= set(r.spans.split(",")) or not base


def test_language_is_told_on_held_out_documents(spark, docs):
    rows = QUERIES["op2_language_id"](spark, SMALL).collect()
    true = dict(zip(docs.doc_id, docs.lang))
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(docs) and len(held) > 20
    assert sum(r.lang_pred == true[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert langid.UNKNOWN not in {r.lang_pred for r in rows}


def test_decontamination_finds_planted_passages(spark, docs):
    items = pd.read_parquet(f"{SMALL}/benchmark.parquet")
    plain = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    expected = {(d, i) for d, t in zip(docs.doc_id, map(plain, docs.text)) for i, q in zip(items.item_id, map(plain, items.text)) if q in t}
    rows = QUERIES["op3_decontamination"](spark, SMALL).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == expected and expected
