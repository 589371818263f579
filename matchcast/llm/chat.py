"""Chat formatting with loss masks that are aligned to token offsets."""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchcast.llm.common import map_arrow

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
OPEN, CLOSE, HEAD, BODY = "<s>", "</s>", "[INST]", "[/INST]"  # a turn is <s>[INST]role[/INST]text</s>
CONTROL = (OPEN, CLOSE, HEAD, BODY)
ESCAPE = "␛"
LOSS_ROLE = "assistant"

_CODES = {ESCAPE: ESCAPE + "0", **{c: f"{ESCAPE}{i}" for i, c in enumerate(CONTROL, 1)}}
_PLAIN = {v: k for k, v in _CODES.items()}
_TO_ESCAPE = re.compile("|".join(map(re.escape, _CODES)))
_TO_PLAIN = re.compile(f"{ESCAPE}[0-4]")
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.S)


def escape(text: str) -> str:
    """No control string is left in the result, nor can one arise, as none has the escape character."""
    return _TO_ESCAPE.sub(lambda m: _CODES[m[0]], text)


def unescape(text: str) -> str:
    return _TO_PLAIN.sub(lambda m: _PLAIN[m[0]], text)


@functools.cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import AddedToken, Tokenizer

    found = Tokenizer.from_file(path)
    found.add_special_tokens([AddedToken(c, normalized=False) for c in CONTROL])
    return found


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one text, and where the texts that are learned stand in it, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{HEAD}{escape(role)}{BODY}", escape(text)
        if role == LOSS_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def intersect(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """For each token ``(first, end)`` the part of it under a span; ``end <= first`` where there is none.

    Both are sorted and spans do not overlap. Control strings are tokens of their own, so a token meets
    one span at most: by binary search the first that ends after the token begins.
    """
    if not len(spans) or not len(offsets):
        return np.zeros((len(offsets), 2), np.int64)
    at = np.searchsorted(spans[:, 1], offsets[:, 0], "right")
    near = spans[np.minimum(at, len(spans) - 1)]
    first, end = np.maximum(offsets[:, 0], near[:, 0]), np.minimum(offsets[:, 1], near[:, 1])
    none = (at == len(spans)) | (end <= first)
    return np.where(none[:, None], 0, np.stack([first, end], axis=1))


def _conversations(batches) -> Iterator[tuple[int | None, list[tuple[str, str]]]]:
    """Whole conversations from batches that are sorted by conversation; one is held at a time."""
    rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text"))))
    for conv, turns in groupby(rows, key=lambda r: r[0]):
        yield conv, [(role or "", text or "") for _, role, text in turns]


SCHEMA = (
    "conv_id long, formatted string, token_ids array<int>, token_first array<int>, token_end array<int>, "
    "loss_first array<int>, loss_end array<int>"
)


def format_chats(conversations: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per conversation: the rendered text, its tokens with offsets, and each token's part under the loss.

    Turns stand in the order of ``turn``, then role, then text; a null turn is first, and rows that repeat are all kept.
    Null texts and roles are empty, rows without ``conv_id`` one conversation. The whole text is
    encoded once. Token i covers code points ``token_first[i]:token_end[i]``, of which
    ``loss_first[i]:loss_end[i]`` are learned (0:0: none). Tokens that share a code point, as
    one character's bytes may, have the same offsets. The rows of one conversation meet in one
    task, one conversation at a time: its text is a single value.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = pa.schema(
        [("conv_id", pa.int64()), ("formatted", pa.string())]
        + [(c, pa.list_(pa.int32())) for c in ("token_ids", "token_first", "token_end", "loss_first", "loss_end")]
    )

    def run(batches):
        encode = _tokenizer(tokenizer)
        held, size = [], 0
        for conv, turns in _conversations(batches):
            text, spans = render(turns)
            tokens = encode.encode(text, add_special_tokens=False)
            offsets = np.array(tokens.offsets, np.int64).reshape(-1, 2)
            loss = intersect(offsets, np.array(spans, np.int64).reshape(-1, 2))
            held.append((conv, text, tokens.ids, offsets[:, 0], offsets[:, 1], loss[:, 0], loss[:, 1]))
            size += len(text)
            if size > 1 << 20:
                yield _batch(held, schema)
                held, size = [], 0
        if held:
            yield _batch(held, schema)

    return map_arrow(dealt.select("conv_id", "role", "text"), run, SCHEMA)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def loss_texts(formatted: str, first: np.ndarray, end: np.ndarray) -> str:
    """The text under the loss mask, unescaped; code points that several tokens cover count once."""
    pieces, done = [], 0
    for a, b in zip(first.tolist(), end.tolist()):
        if b > max(a, done):
            pieces.append(formatted[max(a, done) : b])
            done = b
    return unescape("".join(pieces))


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted rows hold: turns from the text, learned text from the tokens' mask."""

    def run(batches):
        for batch in batches:
            out = []
            for conv, text, first, end in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_first", "loss_end"))):
                turns = parse(text)
                whole = "".join(f"{role}\n{body}\n" for role, body in turns)
                loss = loss_texts(text, np.array(first, np.int64), np.array(end, np.int64))
                digests = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
                out.append((conv, len(turns), digests[0], len(loss), digests[1], len(text)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out) if out else [[]] * 6, kinds)], names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_arrow(formatted.select("conv_id", "formatted", "loss_first", "loss_end"), run, schema)
