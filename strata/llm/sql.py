"""DuckDB SQL of the queries that SQL can express over whole tables."""

import math

from . import secret_scan

MIX = r"""
sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM {docs}),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, ([5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         3.0::DOUBLE * source_size AS cap
  FROM per_source),
levels AS (
  SELECT *, row_number() OVER by_cap AS place,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER (by_cap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
           / sum(weight) OVER (by_cap ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted WINDOW by_cap AS (ORDER BY cap / weight, source NULLS LAST)),
level AS (
  SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= cap),
targets AS (
  SELECT source, source_size, least(cap, level.level * weight) AS target FROM weighted, level),
rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets),
drawn AS (
  SELECT sized.*, source_size, target, rate, ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 7))::BIGINT AS x,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 8, 7))::BIGINT AS y
  FROM sized JOIN rated ON sized.source IS NOT DISTINCT FROM rated.source),
seeded AS (
  SELECT source, seed, any_value(target) AS target, any_value(source_size) AS source_size, any_value(rate) AS rate,
         coalesce(sum(size) FILTER (WHERE (x + seed * y) % 268435456 < (rate - floor(rate)) * 268435456), 0) AS taken
  FROM drawn, unnest(range(64)) AS s(seed) GROUP BY source, seed),
seeds AS (
  SELECT source, arg_min(seed, (abs(taken - (target - floor(rate) * source_size)), seed)) AS seed FROM seeded GROUP BY source),
mixed AS (
  SELECT drawn.*, (((x + seed * y) % 268435456) / 268435456.0::DOUBLE) AS draw
  FROM drawn JOIN seeds ON drawn.source IS NOT DISTINCT FROM seeds.source)
"""

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINES = r"""
split AS (
  SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM {docs}),
lines AS (
  SELECT row_id, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split),
keyed AS (
  SELECT *, """ + LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))") + r""" AS key FROM lines),
common AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= {min_docs}),
kept AS (
  SELECT row_id, keyed.doc_id, count(*)::BIGINT AS n_lines, count(common.key)::BIGINT AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE common.key IS NULL), '') AS text
  FROM keyed LEFT JOIN common USING (key) GROUP BY ALL)
"""

#: The CRC-32 of a text's UTF-8 bytes, from a table made by its rule.
CRC_TABLE = """
crc_rule AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS crc_of)"""
CRC = """xor(list_reduce(list_transform(range(strlen({0})), lambda i: ('0x' || substr(hex(encode({0})), 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"""


def _leaf(text: str) -> str:
    fields = [("doc_id", "doc_id::VARCHAR"), ("source", "source"), ("lang", "lang"), ("n_chars", "n_chars::VARCHAR"), ("text", text)]
    return "sha256(concat(" + ", ".join(f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}) || ':' || {v} END" for _, v in fields) + "))"


MERKLE = f"""WITH RECURSIVE {CRC_TABLE},
shown AS (
  SELECT *, CASE WHEN {CRC.format("doc_id::VARCHAR")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS shown_text
  FROM documents, crc_rule),
leaves AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, {_leaf("text")} AS leaf, {_leaf("shown_text")} AS shown FROM shown),
placed AS (
  SELECT *, coalesce('=' || source, '') AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, row_id) - 1 AS pos FROM leaves),
nodes AS (
  SELECT 0 AS level, tree, pos, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT *, count(*) OVER (PARTITION BY tree) FROM (
    SELECT level + 1, tree, pos // 3 AS pos, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY 1, 2, 3)),
subroots AS (
  SELECT tree, digest AS subroot, level AS height, row_number() OVER (ORDER BY tree) - 1 AS top_pos FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, top_pos AS pos, subroot AS digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT *, count(*) OVER () FROM (
    SELECT level + 1, pos // 3 AS pos, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY 1, 2)),
known AS (
  SELECT tree, level, pos, digest FROM nodes WHERE n > 1
  UNION ALL SELECT 'top', level, pos, digest FROM tops WHERE n > 1),
siblings AS (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS lefts,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS rights
  FROM known a JOIN known b ON a.tree = b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3
  GROUP BY ALL),
way AS (
  SELECT row_id, placed.tree, level, pos // (3 ** level)::BIGINT AS pos, level AS step
  FROM placed JOIN subroots USING (tree), unnest(range(height)) AS l(level)
  UNION ALL
  SELECT row_id, 'top', level, top_pos // (3 ** level)::BIGINT, height + level
  FROM placed JOIN subroots USING (tree), (SELECT DISTINCT level FROM tops WHERE n > 1)),
proofs AS (
  SELECT row_id, string_agg(lefts || rights, '' ORDER BY step) AS proof, list(lefts || ':' || rights ORDER BY step) AS steps
  FROM way JOIN siblings USING (tree, level, pos) GROUP BY row_id),
folded AS (
  SELECT placed.*, subroot, coalesce(proof, '') AS proof,
         list_reduce(coalesce(steps, []), lambda node, s: sha256(split_part(s, ':', 1) || node || split_part(s, ':', 2)), shown) AS folded_root
  FROM placed JOIN subroots USING (tree) LEFT JOIN proofs USING (row_id))
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded_root, folded_root = digest AS verified
FROM folded, tops WHERE n = 1
"""

SPELLING = f"""WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[a-z\u00C0-\u00FF]+')) AS low FROM documents),
distinct_runs AS (SELECT doc_id, low, coalesce(doc_id::VARCHAR, 'null') || ':' || low AS hashed, count(*) AS n FROM runs GROUP BY ALL),
crc AS (SELECT low, n, {CRC.format("hashed")} AS crc FROM distinct_runs, crc_rule),
results AS (
  SELECT CASE WHEN crc % 97 = 0 THEN substr(low, 1, (crc % length(low))::BIGINT) || substr(low, (crc % length(low))::BIGINT + 2) ELSE low END AS word, n FROM crc),
words AS (SELECT word, sum(n)::BIGINT AS n FROM results WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM words, unnest(range(1, length(word) + 1)) AS p(i)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT DISTINCT cut.word, words.word, words.n FROM cut JOIN words ON words.word = head || tail
  UNION SELECT DISTINCT words.word, cut.word, cut.n FROM cut JOIN words ON words.word = head || tail),
best AS (
  SELECT word, count(*) AS n_near, max(n) AS form_n, arg_min(other, (-n, other)) AS form FROM near GROUP BY word),
judged AS (
  SELECT words.word, words.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN form_n >= 2 * words.n THEN form END AS form, CASE WHEN form_n >= 2 * words.n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
followed AS (
  SELECT word, word AS root, 0 AS steps FROM judged
  UNION ALL SELECT followed.word, judged.form, steps + 1 FROM followed JOIN judged ON followed.root = judged.word WHERE judged.form IS NOT NULL)
SELECT word, form, arg_max(root, steps) AS root, any_value(n) AS n, any_value(n_near) AS n_near, any_value(form_n) AS form_n
FROM followed JOIN judged USING (word) GROUP BY word, form
"""

def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _found(rank: int, name: str, pattern: str, group: int, least: int) -> str:
    p = _quoted(pattern)
    return f"""
  SELECT row_id, {rank} AS rank, {least} AS least, unnest(regexp_extract_all(text, {p})) AS m, unnest(regexp_extract_all(text, {p}, {group})) AS piece,
         unnest((string_split_regex(text, {p}))[1:len(regexp_extract_all(text, {p}))]) AS gap,
         generate_subscripts(regexp_extract_all(text, {p}), 1) AS i
  FROM texts WHERE regexp_matches(text, {p})"""


def _secrets() -> str:
    """Windows are counted one by one here, not step by step."""
    w, kinds = secret_scan.WINDOW, secret_scan.KINDS
    found = [_found(r, k, p, g, n) for r, (k, (p, g, n)) in enumerate(secret_scan.BASE.items())]
    found += [_found(kinds.index(k.name), k.name, k.pattern, 0, 0) for k in secret_scan.ENTROPY]
    weights = ", ".join(str(round(c * math.log2(c) * secret_scan.UNIT) if c else 0) for c in range(w + 1))
    above = " OR ".join(
        f"(rank = {kinds.index(k.name)} AND total <= {k.most} AND digits >= {k.digits} AND upper >= {k.upper} AND lower >= {k.lower}"
        f" AND upper + lower >= {k.letters})"
        for k in secret_scan.ENTROPY
    )
    names = "[" + ", ".join(f"'{k}'" for k in kinds) + "]"
    return f"""WITH
texts AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(found)}),
ended AS (
  SELECT *, (sum(length(gap) + length(m)) OVER (PARTITION BY row_id, rank ORDER BY i))::BIGINT AS stop FROM found),
base AS (SELECT row_id, rank, stop - length(m) AS start, stop FROM ended WHERE rank < 3 AND length(piece) >= least),
judged AS (
  SELECT row_id, rank, stop - length(m) AS start, stop, m, regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]') AS mixed,
         regexp_matches(m, {_quoted(secret_scan.ALLOWED)}) OR regexp_matches(right(gap, {secret_scan.BEFORE}), {_quoted(secret_scan.ALLOWED_BEFORE)}) AS off
  FROM ended WHERE rank >= 3),
candidates AS (
  SELECT row_id, rank, start, m FROM judged
  WHERE mixed AND NOT off AND NOT EXISTS (
    FROM judged AS wide WHERE wide.row_id = judged.row_id AND wide.rank = {kinds.index(secret_scan.WIDEST.name)} AND wide.off
      AND wide.start <= judged.start AND judged.start < wide.stop)),
windows AS (
  SELECT row_id, rank, start, w, substr(m, w + 1, {w}) AS held FROM candidates, unnest(range(length(m) - {w} + 1)) AS p(w)),
chars AS (
  SELECT row_id, rank, start, w, c, count(*) AS n FROM windows, unnest(string_split(held, '')) AS u(c) GROUP BY ALL),
counted AS (
  SELECT row_id, rank, start, w, sum(([{weights}])[n + 1]) AS total, coalesce(sum(n) FILTER (WHERE c BETWEEN '0' AND '9'), 0) AS digits,
         coalesce(sum(n) FILTER (WHERE c BETWEEN 'A' AND 'Z'), 0) AS upper, coalesce(sum(n) FILTER (WHERE c BETWEEN 'a' AND 'z'), 0) AS lower
  FROM chars GROUP BY ALL),
hot AS (
  SELECT row_id, rank, start + min(w) AS start, start + max(w) + {w} AS stop FROM counted WHERE {above} GROUP BY row_id, rank, counted.start),
spans AS (
  SELECT *, ({names})[rank + 1] || ':' || start || ':' || stop AS span FROM (SELECT * FROM base UNION ALL SELECT * FROM hot)),
listed AS (
  SELECT row_id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access,
         count(*) FILTER (WHERE rank = 2) AS n_hex, count(*) FILTER (WHERE rank > 2) AS n_entropy,
         string_agg(span, ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS base, string_agg(span, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY row_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       coalesce(n_entropy, 0) AS n_entropy, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (row_id)
"""


SQL = {
    "op12_secret_scan": _secrets(),
    "op11_spelling_variants": SPELLING,
    "op13_merkle_manifest": MERKLE,
    "op4_line_dedup": "WITH" + LINES.format(docs="documents", min_docs=10) + """
SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM kept
""",
    "op7_poly_dedup": f"""
WITH low AS (SELECT doc_id, {LOWER.format("coalesce(text, '')")} AS low FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(low) AS text_sha256
FROM low WINDOW same AS (PARTITION BY low)
""",
    "op8_mix_sources": "WITH" + MIX.format(docs="documents") + """
SELECT doc_id, size, source_size, target,
       size * (floor(rate)::BIGINT + (draw < rate - floor(rate))::BIGINT) AS taken
FROM mixed
""",
}
