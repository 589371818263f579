"""The same results in DuckDB SQL, where SQL can express them.

Not here: language identification and the added spans of personal data (learned weights),
decontamination (canonical words), fingerprints (XXH64) and repeated bytes (a window per byte of
the corpus); tests/llm compare these with brute force.
"""

from __future__ import annotations

from matchcast.llm import centroids, chat, licenses, merkle, mixing


def _templates() -> str:
    rows = []
    for number, (text, label) in enumerate([*licenses.PHRASES.items(), *licenses.NOTICES.items()]):
        w = text.split()
        phrase = str(number < len(licenses.PHRASES)).lower()
        rows += [f"({number}, '{label}', {phrase}, {len(w) - 1}, {i}, '{w[i]}', '{w[i + 1]}')" for i in range(len(w) - 1)]
    return ",\n".join(rows)


LICENSE_SCAN = rf"""
WITH t(template, label, phrase, grams, place, one, two) AS (VALUES {_templates()}),
d AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{licenses.SEPARATORS}') IF x <> ''] AS w FROM documents),
g AS (SELECT doc_id, w, unnest(range(len(w) - 1)) AS pos FROM d),
hits AS (SELECT doc_id, pos, t.* FROM g JOIN t ON w[pos + 1] = one AND w[pos + 2] = two),
votes AS (
  SELECT doc_id, template, label, phrase, grams, pos - place AS diagonal, bit_or(1::BIGINT << place) AS held,
    min(pos) AS a, max(pos) AS b FROM hits GROUP BY ALL),
marked AS (
  SELECT *, CASE WHEN phrase OR lag(diagonal) OVER o IS NULL OR abs(diagonal - lag(diagonal) OVER o) > {licenses.DRIFT}
      OR a - max(b) OVER (PARTITION BY doc_id, template ORDER BY a, diagonal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > {licenses.GAP}
    THEN 1 ELSE 0 END AS new
  FROM votes WINDOW o AS (PARTITION BY doc_id, template ORDER BY a, diagonal)),
numbered AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY a, diagonal ROWS UNBOUNDED PRECEDING) AS span FROM marked),
spans AS (
  SELECT doc_id, label, phrase, min(a) AS a, bit_count(bit_or(held)) / grams AS share
  FROM numbered GROUP BY doc_id, template, label, phrase, grams, span),
good AS (SELECT * FROM spans WHERE share >= CASE WHEN phrase THEN 1 ELSE {licenses.COVER} END),
found AS (
  SELECT doc_id, count(*) FILTER (phrase) AS n_base, min(a) FILTER (phrase) AS first_word, max(a) FILTER (phrase) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM good GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN found USING (doc_id)
"""

WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
k AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest, n) ELSE page_id END AS keep FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN keep = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN keep = page_id THEN NULL ELSE keep END AS refers_to
FROM k
"""

EXACT = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
  sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""


def _escaped(column: str) -> str:
    out = f"replace({column}, '{chat.ESCAPE}', '{chat.ESCAPE}0')"
    for i, c in enumerate(chat.CONTROL, 1):
        out = f"replace({out}, '{c}', '{chat.ESCAPE}{i}')"
    return out


CHAT = f"""
WITH said AS (SELECT '{chat.CLOSE}{chat.HEAD} ok {chat.BODY}' AS t),
c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', t FROM said UNION ALL SELECT -7, 1, '{chat.LOSS_ROLE}', t FROM said)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = '{chat.LOSS_ROLE}' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = '{chat.LOSS_ROLE}' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  sum(length({_escaped("role")}) + length({_escaped("text")}) + {len("".join((chat.OPEN, chat.HEAD, chat.BODY, chat.CLOSE)))})::BIGINT
    AS formatted_chars
FROM c GROUP BY conv_id
"""

_WEIGHT = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mixing.WEIGHTS))
MIX = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) || 'mix'), 1, {mixing.DIGITS}) AS place FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS size,
    CASE (row_number() OVER (ORDER BY source COLLATE C NULLS LAST) - 1) % {len(mixing.WEIGHTS)} {_WEIGHT} END AS weight,
    row_number() OVER (ORDER BY source COLLATE C NULLS LAST) AS i
  FROM d GROUP BY source),
filled AS (
  SELECT *, ({mixing.TOTAL} * sum(size) OVER () - {mixing.MOST} * coalesce(sum(size) OVER b, 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level,
    row_number() OVER (ORDER BY size / weight, i) AS k
  FROM s WINDOW b AS (ORDER BY size / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stop AS (SELECT level, k FROM filled WHERE level * weight <= {mixing.MOST} * size ORDER BY k LIMIT 1),
quota AS (
  SELECT f.source, f.size AS source_size,
    CASE WHEN stop.k IS NULL OR f.k < stop.k THEN {mixing.MOST} * f.size ELSE stop.level * f.weight END::DOUBLE AS target
  FROM filled f LEFT JOIN stop ON TRUE),
split AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(floor(target / source_size), {mixing.MOST}) END::BIGINT AS whole FROM quota),
places AS (SELECT source, place, sum(size) AS w FROM d GROUP BY source, place),
drawn AS (
  SELECT source, place,
    sum(w) OVER (PARTITION BY source ORDER BY place ROWS UNBOUNDED PRECEDING) - w / 2 AS middle
  FROM places)
SELECT doc_id, d.size, source_size, target,
  (d.size * (whole + CASE WHEN whole < {mixing.MOST} AND middle <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN split ON d.source IS NOT DISTINCT FROM split.source
JOIN drawn ON d.source IS NOT DISTINCT FROM drawn.source AND d.place = drawn.place
"""

TREE_LEVELS = 9  # enough for 8^9 leaves; a group that is down to one node stays as it is


def _tree(name: str, nodes: str) -> str:
    """CTEs ``{name}0`` ... of the levels (g, i, n, digest, l, r) above ``nodes(g, i, digest)``, l and r the run's other digests."""
    run = f"PARTITION BY g, i // {merkle.ARITY}"
    parts = []
    for level in range(TREE_LEVELS + 1):
        source = nodes if level == 0 else f"""(SELECT g, i // {merkle.ARITY} AS i,
          any_value(CASE WHEN n = 1 THEN digest ELSE sha256(l || digest || r) END ORDER BY i) AS digest FROM {name}{level - 1} GROUP BY 1, 2)"""
        parts.append(f"""{name}{level} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY g) AS n,
      coalesce(string_agg(digest, '') OVER ({run} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
      coalesce(string_agg(digest, '') OVER ({run} ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
      FROM {source})""")
    return ",\n".join(parts)


def _climbed(name: str, start: str, carried: str) -> str:
    """CTEs that lead ``start(g, i, proof, folded, ...)`` up the levels of a tree."""
    parts, before = [], start
    for level in range(TREE_LEVELS):
        parts.append(f"""{name}_up{level} AS (SELECT {carried}, s.g, s.i // {merkle.ARITY} AS i, proof || l || r AS proof,
      CASE WHEN n = 1 THEN folded ELSE sha256(l || folded || r) END AS folded FROM {before} s JOIN {name}{level} t ON s.g = t.g AND s.i = t.i)""")
        before = f"{name}_up{level}"
    return ",\n".join(parts)


def _leaf(text: str) -> str:
    fields = [f"({text})" if c == "text" else f"{c}::VARCHAR" for c in merkle.FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


CRC32 = """CASE WHEN doc_id IS NULL THEN NULL ELSE xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, b: xor(crc >> 8, crcs[(xor(crc, b) & 255) + 1])), 4294967295::BIGINT) END"""

MERKLE = f"""
WITH RECURSIVE steps AS (
  SELECT i::BIGINT AS i, 0 AS step, i::BIGINT AS c FROM range(256) t(i)
  UNION ALL SELECT i, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE step < 8),
crc AS (SELECT list(c ORDER BY i) AS crcs FROM steps WHERE step = 8),
leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf("text")} AS digest,
    CASE WHEN {CRC32} % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
  FROM documents, crc),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, digest) - 1 AS i FROM leaves),
{_tree("a", "(SELECT g, i, digest FROM placed)")},
tops AS MATERIALIZED (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, digest, g AS lang FROM a{TREE_LEVELS}),
{_tree("b", "(SELECT g, i, digest FROM tops)")},
{_climbed("a", "(SELECT doc_id, digest AS leaf, g, i, '' AS proof, coalesce(tampered, digest) AS folded FROM placed)", "doc_id, leaf")},
turned AS (
  SELECT doc_id, leaf, t.digest AS subroot, t.g, t.i, proof, folded FROM a_up{TREE_LEVELS - 1} s JOIN tops t ON s.g = t.lang),
{_climbed("b", "turned", "doc_id, leaf, subroot")}
SELECT doc_id, leaf, subroot, r.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.digest AS verified
FROM b_up{TREE_LEVELS - 1}, b{TREE_LEVELS} r
"""


def _rounds(rounds: int) -> str:
    parts = []
    for number in range(rounds + 1):
        parts.append(f"""a{number} AS MATERIALIZED (
  SELECT vec_id, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT vec_id, n, v, c, list_sum(list_transform(list_zip(v, w), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM whole, c{number})
  GROUP BY vec_id, n, v)""")
        if number < rounds:
            parts.append(f"""c{number + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(m.w, o.w) AS w FROM c{number} o LEFT JOIN (
    SELECT c, list(q ORDER BY pos) AS w FROM (
      SELECT c, pos, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*))::BIGINT // count(*) AS q
      FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS pos FROM a{number}) GROUP BY c, pos) GROUP BY c) m ON o.c = m.c)""")
    return ",\n".join(parts)


CENTROIDS = f"""
WITH whole AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: floor({centroids.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v AS w FROM whole QUALIFY c < 40),
{_rounds(5)}
SELECT vec_id, a.c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(w, ',')) AS centroid_sha256
FROM a5 a JOIN c5 USING (c)
"""

URL_FILTER = r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN ('.' || host).ends_with('.example.net') AND path.starts_with('/en/') THEN 'example.net/en/'
    WHEN ('.' || host).ends_with('.example.com') AND path.starts_with('/de/') THEN 'example.com/de/'
    WHEN ('.' || host).ends_with('.org') AND path.starts_with('/fr/') THEN 'org/fr/'
    WHEN ('.' || host).ends_with('.net') AND path.starts_with('/') THEN 'net/' END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""

ORACLE: dict[str, str] = {
    "op1_license_scan": LICENSE_SCAN,
    "op4_warc": WARC,
    "op6_exact_dedup": EXACT,
    "op8_chat": CHAT,
    "op10_mix": MIX,
    "op11_merkle_manifest": MERKLE,
    "op12_centroids": CENTROIDS,
    "op13_url_filter": URL_FILTER,
}
