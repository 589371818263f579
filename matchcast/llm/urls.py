"""URL filters: a trie over reversed host labels and path segments, with the longest entry deciding between allow and block."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchcast.llm.common import map_arrow, release, settle

ALLOW, BLOCK = "allow", "block"
MOST_CHARS = 1 << 24  # of the entries of one trie, some hundreds of MB as a trie at the worst; more entries are several tries
ENTRY_CHARS = 32  # that an entry counts beside its own
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
VERDICTS, TAILS = 0, 1  # keys of a node that are no labels or segments


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL; both are empty without ``://``."""
    whole = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(whole, PARTS, 1), CAPITALS, SMALL), F.regexp_extract(whole, PARTS, 2)


def entries(spark: SparkSession, block: Iterable[str], allow: Iterable[str]) -> DataFrame:
    """``host, path, verdict`` of entries such as ``example.net/en/``."""
    rows = [(e.partition("/")[0], "/" + e.partition("/")[2] if "/" in e else "", v) for v, es in ((BLOCK, block), (ALLOW, allow)) for e in es]
    return spark.createDataFrame(rows, "host string, path string, verdict string")


def trie(rows: Iterable[tuple[str, str, str]]) -> dict:
    """Labels of the reversed host lead to a node; from its ``VERDICTS`` the path's whole segments lead on.

    What follows an entry's last slash may end inside a segment: it stands among the ``TAILS`` there, by length.
    """
    top: dict = {}
    for host, path, verdict in rows:
        node = top
        for label in reversed(host.split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(VERDICTS, {})
        *segments, tail = path.split("/")
        for segment in segments:
            node = node.setdefault(segment, {})
        node.setdefault(TAILS, {}).setdefault(len(tail), {})[tail] = verdict
    return top


def _longest_path(node: dict, segments: list[str]) -> tuple[int, str] | None:
    """The longest path of an entry that the segments start with, and its verdict."""
    found, before = None, 0
    for segment in segments:
        for length in sorted(node.get(TAILS, ())):
            verdict = node[TAILS][length].get(segment[:length]) if length <= len(segment) else None
            if verdict is not None:
                found = (before + length, verdict)
        if segment not in node:
            break
        node, before = node[segment], before + len(segment) + 1
    return found


def longest(top: dict, host: str, path: str) -> tuple[str, str, str] | None:
    """The entry (host, path, verdict) that decides: the longest host that has a fitting path, and of its paths the longest."""
    labels, segments = host.split("."), path.split("/")
    node, held = top, []
    for used, label in enumerate(reversed(labels), start=1):
        node = node.get(label)
        if node is None:
            break
        if VERDICTS in node:
            held.append((used, node[VERDICTS]))
    for used, paths in reversed(held):
        found = _longest_path(paths, segments)
        if found is not None:
            return ".".join(labels[-used:]), path[: found[0]], found[1]
    return None


def _ruled(rows: DataFrame, top: dict, names: list[str], kept: list[str]) -> DataFrame:
    """``rows`` with the deciding entry of this trie, where it is longer than the one they have."""
    shared = rows.sparkSession.sparkContext.broadcast(top)
    host, path, *ruled = names

    def run(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in names]
            out = []
            for h, p, *had in zip(*columns):
                found = longest(shared.value, h, p) if h else None
                better = found is not None and (had[0] is None or (len(found[0]), len(found[1])) > (len(had[0]), len(had[1])))
                out.append(found if better else tuple(had))
            sides = [pa.array(c, pa.string()) for c in zip(*out)] if out else [pa.array([], pa.string())] * 3
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *sides], [*kept, *ruled])

    return map_arrow(rows, run, rows.schema)


def judge(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = ALLOW, names: tuple = ("host", "path", "rule", "verdict")) -> DataFrame:
    """``urls`` with the host and path of each, the entry that decides, and its verdict.

    ``rules`` has ``host, path, verdict``. An entry fits its host and all subdomains if the URL's path starts with the entry's.
    Of those that fit, the longest host decides, and then the longest path; an entry that is both allowed and blocked is
    allowed. A URL that none fits, has no host or is null has no rule (null) and the default. Entries without a host, or with a
    null, are none. Rows stay as they are, repeated ones too; no ``urls`` give no rows. The columns that ``names`` adds may not
    be there yet.

    The trie is broadcast; entries of more than 2^24 characters are dealt by hash to as many tries as hold them, which are
    broadcast one after the other: the longest entry of all of them decides, as in one.
    """
    clash = set(names) & set(urls.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already")
    known = rules.filter("host != '' AND path IS NOT NULL AND verdict IS NOT NULL")
    known = settle(known.groupBy(F.translate("host", CAPITALS, SMALL).alias("host"), "path").agg(F.min("verdict").alias("verdict")))
    size = known.agg(F.sum(F.length("host") + F.length("path") + F.lit(ENTRY_CHARS))).first()[0] or 0
    tries = max(math.ceil(size / MOST_CHARS), 1)
    host, path = url_parts(F.col(url_col))
    work = [f"_{c}_{uuid.uuid4().hex}" for c in ("host", "path", "rule_host", "rule_path", "rule_verdict")]
    unruled = {c: F.lit(None).cast("string") for c in work[2:]}
    rows = urls.withColumns({work[0]: host, work[1]: path, **unruled})
    kept = [c for c in rows.columns if c not in unruled]
    for number in range(tries):
        part = known.filter(F.pmod(F.xxhash64("host", "path"), F.lit(tries)) == number).collect()
        before = rows
        rows = _ruled(rows, trie((r["host"], r["path"], r["verdict"]) for r in part), work, kept)
        if tries > 1:
            rows = settle(rows)  # one trie at a time is in the executors' memory
            release(before)
    release(known)
    out = [F.col(work[0]), F.col(work[1]), F.concat(work[2], work[3]), F.coalesce(work[4], F.lit(default))]
    return rows.select(*(F.col(f"`{c}`") for c in urls.columns), *(c.alias(n) for c, n in zip(out, names)))


def keep_allowed(docs: DataFrame, rules: DataFrame, url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """The rows whose URL is allowed, all columns as they were."""
    names = tuple(f"_{n}_{uuid.uuid4().hex}" for n in ("host", "path", "rule", "verdict"))
    return judge(docs, rules, url_col, default, names).filter(F.col(names[3]) == ALLOW).drop(*names)
