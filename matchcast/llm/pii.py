"""Personal data: fixed patterns, and a character-level bidirectional LSTM with a CRF that adds to them."""

from __future__ import annotations

import functools
import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchcast.llm.common import byte_texts, map_arrow, text_hash

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
LENGTH, STRIDE, MARGIN = 64, 32, 24  # of windows, in code points
HIDDEN, EPOCHS, BATCH, RATE = 16, 12, 48, 0.02
SAMPLE_DOCS, SAMPLE_WINDOWS = 20000, 1200  # the bounded sample the network is trained on
SURE = 0.9  # least mean probability of an added span's tags

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")  # runs are taken whole, so no start inside one can match
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]+")
_NOT_DIGIT = re.compile(r"[^0-9]")


def _emails(text: str):
    """As the pattern finds them, but from each @ outward, which is linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        m = _DOMAIN.match(text, at + 1) if first < at else None
        if m:
            yield first, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, in order; matches that fail their check are dropped."""
    out = [(a, 0, b) for a, b in _emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SYMBOLS = "\x00abcdefghijklmnopqrstuvwxyz \n!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
UPPER, DIGIT, LETTER, OTHER = (len(SYMBOLS) + i for i in range(4))
VOCABULARY = len(SYMBOLS) + 4


@functools.cache
def _symbol(c: str) -> int:
    if c in SYMBOLS:
        return SYMBOLS.index(c)
    if c in "0123456789":
        return DIGIT
    if "A" <= c <= "Z":
        return UPPER
    return LETTER if c.isalpha() else OTHER


def window_starts(text: str) -> list[int]:
    """Overlapping windows around every digit and @: each kind of personal data has one of them."""
    starts: list[int] = []
    begin = end = -1
    for m in _TRIGGER.finditer(text):
        if begin >= 0 and m.start() - MARGIN <= end:
            end = m.end() + MARGIN
            continue
        if begin >= 0:
            starts += range(begin, max(end - LENGTH, begin) + STRIDE, STRIDE)
        begin, end = max(m.start() - MARGIN, 0), m.end() + MARGIN
    if begin >= 0:
        starts += range(begin, max(end - LENGTH, begin) + STRIDE, STRIDE)
    return starts


def _encode(text: str, start: int) -> list[int]:
    part = text[start : start + LENGTH]
    return [_symbol(c) for c in part] + [0] * (LENGTH - len(part))


def _tags(spans: list[tuple[int, int, int]], start: int) -> list[int]:
    out = [0] * LENGTH
    for a, k, b in spans:
        for i in range(max(a, start), min(b, start + LENGTH)):
            out[i - start] = 1 + 2 * k + (i > a)
    return out


@dataclass
class Network:
    """Input and recurrent weights of both directions, output weights, transitions and start scores of the CRF."""

    w: dict[str, np.ndarray]

    @staticmethod
    def new(seed: int) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) * 0.15).astype(np.float32)
        w = {f"x{d}": draw(VOCABULARY, 4 * HIDDEN) for d in "fb"} | {f"h{d}": draw(HIDDEN, 4 * HIDDEN) for d in "fb"}
        for d in "fb":
            w[f"x{d}"][:, HIDDEN : 2 * HIDDEN] += 0.5  # the forget gate begins open
        return Network(w | {"o": draw(2 * HIDDEN, TAGS), "c": np.zeros(TAGS, np.float32), "t": draw(TAGS, TAGS), "s": np.zeros(TAGS, np.float32)})

    def _run(self, ids: np.ndarray, d: str) -> tuple:
        """States over time; ids are (time, window), the backward direction's reversed by the caller."""
        steps, n = ids.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        hs, cs, gates = [], [], []
        for t in range(steps):
            a = self.w[f"x{d}"][ids[t]] + h @ self.w[f"h{d}"]
            a[:, : 3 * HIDDEN] = 1 / (1 + np.exp(-a[:, : 3 * HIDDEN]))
            a[:, 3 * HIDDEN :] = np.tanh(a[:, 3 * HIDDEN :])
            i, f, o, g = np.split(a, 4, axis=1)
            c = f * c + i * g
            h = o * np.tanh(c)
            hs.append(h)
            cs.append(c)
            gates.append(a)
        return np.stack(hs), np.stack(cs), np.stack(gates)

    def emissions(self, ids: np.ndarray) -> tuple[np.ndarray, tuple]:
        forward, backward = self._run(ids, "f"), self._run(ids[::-1], "b")
        h = np.concatenate([forward[0], backward[0][::-1]], axis=2)
        return h @ self.w["o"] + self.w["c"], (h, forward, backward)

    def marginals(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of tags and summed ones of transitions, and the log of the CRF's sum."""
        steps, n, _ = e.shape
        top = lambda x, axis: (m := x.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis=axis))
        e, t = e.astype(np.float64), self.w["t"].astype(np.float64)
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0] + self.w["s"]
        for k in range(1, steps):
            alpha[k] = top(alpha[k - 1][:, :, None] + t, 1) + e[k]
        for k in range(steps - 2, -1, -1):
            beta[k] = top(t + (e[k + 1] + beta[k + 1])[:, None, :], 2)
        z = top(alpha[-1], 1)
        pairs = np.zeros_like(t)
        for k in range(1, steps):
            pairs += np.exp(alpha[k - 1][:, :, None] + t + (e[k] + beta[k])[:, None, :] - z[:, None, None]).sum(axis=0)
        return np.exp(alpha + beta - z[None, :, None]), pairs, z

    def best(self, e: np.ndarray) -> np.ndarray:
        """The likeliest tags of each window (Viterbi)."""
        steps, n, _ = e.shape
        score, back = e[0] + self.w["s"], np.zeros(e.shape, np.int8)
        for k in range(1, steps):
            ways = score[:, :, None] + self.w["t"]
            back[k] = ways.argmax(axis=1)
            score = ways.max(axis=1) + e[k]
        tags = np.zeros((steps, n), np.int8)
        tags[-1] = score.argmax(axis=1)
        for k in range(steps - 1, 0, -1):
            tags[k - 1] = np.take_along_axis(back[k], tags[k][:, None].astype(np.int64), axis=1)[:, 0]
        return tags

    def gradients(self, ids: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-likelihood of the tags; both are (time, window)."""
        steps, n = ids.shape
        e, (h, forward, backward) = self.emissions(ids)
        p, pairs, _ = self.marginals(e)
        gold = np.eye(TAGS)[tags]
        de = ((p - gold) / n).astype(np.float32)
        seen = np.zeros_like(pairs)
        np.add.at(seen, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        flat = de.reshape(-1, TAGS)
        out = {"o": h.reshape(-1, 2 * HIDDEN).T @ flat, "c": flat.sum(axis=0), "t": (pairs - seen) / n, "s": de[0].sum(axis=0)}
        dh = de @ self.w["o"].T
        for d, (hs, cs, gates), grad, inputs in (("f", forward, dh[:, :, :HIDDEN], ids), ("b", backward, dh[::-1, :, HIDDEN:], ids[::-1])):
            gx, gh = np.zeros_like(self.w[f"x{d}"]), np.zeros_like(self.w[f"h{d}"])
            later, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
            for k in range(steps - 1, -1, -1):
                i, f, o, g = np.split(gates[k], 4, axis=1)
                th = np.tanh(cs[k])
                total = grad[k] + later
                dc = dc + total * o * (1 - th * th)
                before = cs[k - 1] if k else 0.0
                da = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), total * th * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                np.add.at(gx, inputs[k], da)
                if k:
                    gh += hs[k - 1].T @ da
                later, dc = da @ self.w[f"h{d}"].T, dc * f
            out |= {f"x{d}": gx, f"h{d}": gh}
        return out


def train(windows: np.ndarray, tags: np.ndarray, seed: int = 11, epochs: int = EPOCHS) -> Network | None:
    """Fit by Adam on (window, time) arrays; None without a labelled span."""
    if not len(windows) or not tags.any():
        return None
    net, rng = Network.new(seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for begin in range(0, len(order), BATCH):
            part = np.sort(order[begin : begin + BATCH])
            grads = net.gradients(windows[part].T, tags[part].T)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            step += 1
            for k, g in grads.items():
                g = (g * min(1.0, 5.0 / max(norm, 1e-9))).astype(np.float32)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                net.w[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
    return net


def _training_windows(batches):
    for batch in batches:
        rows = []
        for name, text in zip(batch.column("h").to_pylist(), byte_texts(batch.column("t"))):
            t = text.decode("utf-8", "replace")
            starts = window_starts(t)
            spans = base_spans(t) if starts else []
            rows += [(name, s, _encode(t, s), _tags(spans, s)) for s in starts]
        kinds = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [[]] * 4, kinds)], ["h", "s", "ids", "tags"])


def learn(docs: DataFrame, text_col: str = "text") -> Network | None:
    """Train on the windows of a sample: about ``SAMPLE_DOCS`` documents, of their windows ``SAMPLE_WINDOWS`` at most.

    Which ones follows from a hash of the text. Labels are the spans of the fixed patterns; windows without
    one teach what is none. The windows, ``LENGTH`` symbols each, come to the driver.
    """
    total = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(total, 1))
    rows = docs.select(text_hash(text_col).alias("h"), F.col(text_col).alias("t"))
    drawn = rows.filter(F.pmod(F.xxhash64("h", F.lit("pii")), F.lit(1 << 30)) < int(share * (1 << 30)))
    windows = map_arrow(drawn, _training_windows, "h long, s int, ids array<int>, tags array<int>").distinct()
    taken = windows.orderBy(F.xxhash64("h", "s"), "h", "s").limit(SAMPLE_WINDOWS).collect()
    if not taken:
        return None
    return train(np.array([r["ids"] for r in taken]), np.array([r["tags"] for r in taken]))


def added_spans(net: Network, texts: list[str], known: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """Spans the network finds that meet no known one.

    All windows are decoded; where they overlap, a character has the tag of the window it stands
    farthest inside of. Runs of one kind are spans, if they have a digit or @, are no shorter than
    7 and their tags have a mean probability of ``SURE``.
    """
    where = [(i, s) for i, t in enumerate(texts) for s in window_starts(t)]
    votes: list[dict[int, tuple[int, int, float]]] = [{} for _ in texts]
    for begin in range(0, len(where), 1024):
        part = where[begin : begin + 1024]
        ids = np.array([_encode(texts[i], s) for i, s in part]).T
        e, _ = net.emissions(ids)
        tags = net.best(e)
        touched = np.flatnonzero(tags.any(axis=0))
        p = net.marginals(e[:, touched])[0] if len(touched) else None
        column = dict(zip(touched.tolist(), range(len(touched))))
        for k, (i, s) in enumerate(part):
            vote = votes[i]
            for at in range(min(LENGTH, len(texts[i]) - s)):
                inside = min(at if s else LENGTH, LENGTH - 1 - at if s + LENGTH < len(texts[i]) else LENGTH)
                if (s + at) not in vote or vote[s + at][0] < inside:
                    tag = int(tags[at, k])
                    vote[s + at] = (inside, tag, float(p[at, column[k], tag]) if tag else 0.0)
    out = []
    for text, vote, spans in zip(texts, votes, known):
        runs: list[list] = []  # start, kind, end, probabilities
        for at in sorted(vote):
            _, tag, prob = vote[at]
            if not tag:
                continue
            kind, begins = (tag - 1) // 2, tag % 2 == 1
            if runs and not begins and runs[-1][1] == kind and runs[-1][2] == at:
                runs[-1][2] = at + 1
                runs[-1][3] += prob
            else:
                runs.append([at, kind, at + 1, prob])
        good = [
            (a, k, b) for a, k, b, p in runs
            if b - a >= 7 and p / (b - a) >= SURE and _TRIGGER.search(text, a, b) and not any(a < y and x < b for x, _, y in spans)
        ]
        out.append(good)
    return out


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    Counts and digest are those of the fixed patterns; ``spans`` has theirs and those the network adds. Texts are
    read whole; null is empty. An empty table gives no rows, a corpus without any span no network.
    """
    net = learn(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))

    def run(batches):
        model = shared.value
        for batch in batches:
            texts = [t.decode("utf-8", "replace") for t in byte_texts(batch.column("t"))]
            base = [base_spans(t) for t in texts]
            more = added_spans(model, texts, base) if model else [[] for _ in texts]
            counts = [pa.array([sum(k == kind for _, k, _ in b) for b in base], pa.int64()) for kind in range(len(KINDS))]
            digests = pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string())
            spans = pa.array([joined(sorted(b + m)) for b, m in zip(base, more)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), *counts, digests, spans], ["id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    fields = ", ".join(f"n_{k} long" for k in KINDS)
    return map_arrow(rows, run, f"id {kind}, {fields}, base_sha256 string, spans string")
