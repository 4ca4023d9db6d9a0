"""DuckDB statements of the operators that SQL can express, written from their definitions."""

EXACT_DEDUP = """
WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, row_number() OVER () AS r FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size, arg_max(r, coalesce(doc_id, -1)) AS best FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size, r = best AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""

_DRAW = "('0x' || substr(md5(identity || ':' || (k // 4)::VARCHAR), (k % 4) * 8 + 1, 8))::BIGINT / 4294967296.0::DOUBLE"

# the level at which capped targets (3 times the size) and level * weight together use all words
MIXING = f"""
WITH t AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    concat_ws(':', coalesce(doc_id::VARCHAR, 'null'), md5(coalesce(text, '')),
      (row_number() OVER (PARTITION BY doc_id, text ORDER BY source) - 1)::VARCHAR) AS identity
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM t GROUP BY source),
o AS (
  SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS weights,
    coalesce(sum(source_size) OVER (ORDER BY 3 * source_size / w::DOUBLE, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
    coalesce(sum(w) OVER (ORDER BY 3 * source_size / w::DOUBLE, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS closed
  FROM s),
l AS (
  SELECT coalesce(arg_min(level, closed) FILTER (3 * source_size >= level * w), 0) AS level
  FROM (SELECT *, (total - 3 * held)::DOUBLE / (weights - closed)::DOUBLE AS level FROM o)),
r AS (
  SELECT source, source_size, least(3 * source_size::DOUBLE, level * w) AS target,
    CASE WHEN source_size > 0 THEN least(least(3 * source_size::DOUBLE, level * w) / source_size::DOUBLE, 3.0::DOUBLE) ELSE 0.0 END AS rate
  FROM s, l),
d AS (
  SELECT t.*, source_size, target, floor(rate)::BIGINT AS whole, rate - floor(rate) AS part, k, {_DRAW} AS u
  FROM t JOIN r ON t.source IS NOT DISTINCT FROM r.source, range(16) AS seeds(k)),
e AS (
  SELECT source, k, abs(any_value(whole) * any_value(source_size) + sum(CASE WHEN u < part THEN size ELSE 0 END) - any_value(target)) AS off
  FROM d GROUP BY source, k),
b AS (SELECT source, k FROM e QUALIFY row_number() OVER (PARTITION BY source ORDER BY off, k) = 1)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN u < part THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source AND d.k = b.k
"""

QUALITY = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, string_split(text, chr(10)) AS ls FROM t),
windows AS (
  SELECT r, i, [ws[i], ws[i + 1], ws[i + 2]] AS win FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT i + d) AS n FROM again, range(3) AS steps(d) GROUP BY r),
lines AS (
  SELECT r, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw, pos
  FROM (SELECT r, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM w)),
judged AS (
  SELECT r, line, pos, len(lw) AS n, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
    len(lw) > 0 AND (
      len(regexp_extract_all(line, '[#*$%&|<>]')) > 0.3 * len(lw)
      OR len(regexp_extract_all(line, '!')) > 0.3 * len(lw)
      OR (len(lw) >= 12 AND NOT regexp_matches(line, '[.,;:!?…。，、؟।]'))
      OR len(regexp_extract_all(line, '[|»›]')) >= 3
      OR regexp_matches(line, '(?i)^\s*((home|login|log in|logout|sign in|register|menu|next|previous|back to top|share|print|contact( us)?|about( us)?|sitemap|search|faq|help)[\s|>/·»-]*)+$')
      OR regexp_matches(line, '(?i)all rights reserved|cookie (policy|settings|consent)|we use cookies|accept (all )?cookies|privacy policy|terms (of|and) (use|service|conditions)|(enable|requires?) javascript|subscribe to our|sign up for|click here|lorem ipsum|skip to (main )?content|powered by wordpress')
      OR (len(lw) >= 20 AND len(list_distinct(lw)) < 0.3 * len(lw))) AS bad
  FROM lines),
per AS (
  SELECT r, sum(chars)::BIGINT AS word_chars, count(*) FILTER (bad) AS lines_dropped, coalesce(sum(chars) FILTER (bad), 0)::BIGINT AS chars_dropped,
    count(*) FILTER (n > 0) - count(DISTINCT CASE WHEN n > 0 THEN line END) AS n_dup_lines
  FROM judged GROUP BY r),
base AS (
  SELECT doc_id, len(ws) AS n_words, word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words, lines_dropped, chars_dropped
  FROM w JOIN per USING (r) LEFT JOIN covered c USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND chars_dropped <= 0.5 * word_chars AS kept
FROM base
"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes, bit by bit from the lowest of each byte."""
    bits = (
        f"list_transform(range(8 * strlen({text})), lambda i: (instr('123456789ABCDEF', "
        f"substr(hex(encode({text})), 2 * (i // 8) + CASE WHEN i % 8 < 4 THEN 2 ELSE 1 END, 1)) >> (i % 4)) & 1)"
    )
    return f"xor(list_reduce({bits}, lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295::BIGINT), 4294967295::BIGINT)"


_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _leaf(text: str) -> str:
    parts = [text if f == "text" else f"{f}::VARCHAR" for f in _FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({p})::VARCHAR || ':' || {p}, '-')" for p in parts) + ")"


def _climb(name: str, start: str) -> str:
    """All nodes (tree, lvl, pos, n nodes on the level, h) above the leaves `start`."""
    return f"""{name}(tree, lvl, pos, n, h) AS (
  SELECT tree, 0, pos, n, h FROM {start}
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY tree, lvl, pos // 3, n),
{name}_runs AS (SELECT tree, lvl, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM {name} WHERE n > 1 GROUP BY 1, 2, 3)"""


def _fold(name: str, start: str, nodes: str) -> str:
    """Rows of `start` (r, tree, pos, h, proof) carried along their siblings to the tree's root."""
    own = "(pos % 3 + 1)"
    return f"""{name}(r, tree, lvl, pos, h, proof) AS (
  SELECT r, tree, 0, pos, h, proof FROM {start}
  UNION ALL
  SELECT r, f.tree, f.lvl + 1, pos // 3,
    sha256(array_to_string(hs[:{own} - 1], '') || h || array_to_string(hs[{own} + 1:], '')),
    proof || array_to_string(hs[:{own} - 1], '') || array_to_string(hs[{own} + 1:], '')
  FROM {name} f JOIN {nodes}_runs u ON u.tree = f.tree AND u.lvl = f.lvl AND u.run = f.pos // 3),
{name}_ends AS (SELECT r, arg_max(h, lvl) AS h, arg_max(proof, lvl) AS proof FROM {name} GROUP BY r)"""


MERKLE = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, source, {_leaf("text")} AS leaf,
    CASE WHEN {_crc32("(doc_id::VARCHAR)")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} END AS changed
  FROM documents),
sources AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) AS n FROM d GROUP BY source),
leaves AS (
  SELECT r, tree, n, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS h, coalesce(changed, leaf) AS audited
  FROM d JOIN sources s ON s.source IS NOT DISTINCT FROM d.source),
{_climb("lower_nodes", "leaves")},
tops AS (SELECT 0 AS tree, tree AS pos, (SELECT count(*) FROM sources) AS n, h FROM lower_nodes WHERE n = 1),
{_climb("upper_nodes", "tops")},
lower_start AS (SELECT r, tree, pos, audited AS h, '' AS proof FROM leaves),
{_fold("lower_fold", "lower_start", "lower_nodes")},
upper_start AS (SELECT e.r, 0 AS tree, l.tree AS pos, e.h, e.proof FROM lower_fold_ends e JOIN leaves l ON l.r = e.r),
{_fold("upper_fold", "upper_start", "upper_nodes")},
top AS (SELECT h AS root FROM upper_nodes WHERE n = 1)
SELECT doc_id, leaf, t.h AS subroot, root, sha256(proof) AS proof_sha256, e.h AS folded_root, e.h = root AS verified
FROM d JOIN leaves l ON l.r = d.r JOIN tops t ON t.pos = l.tree JOIN upper_fold_ends e ON e.r = d.r, top
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_RUNS = "unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"

IMPORTANCE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
f AS (SELECT r, {_RUNS} AS feature FROM d),
g AS (SELECT {_RUNS} AS feature FROM (SELECT {_TERMS} AS w FROM benchmark)),
b AS (SELECT feature, {_crc32("feature")} % 10000 AS bucket FROM (SELECT feature FROM f UNION SELECT feature FROM g)),
s AS (SELECT bucket, count(*) AS s FROM f JOIN b USING (feature) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM g JOIN b USING (feature) GROUP BY 1),
gains AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM f) + 10000)::DOUBLE)
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM g) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket)),
sums AS (SELECT r, count(*) AS n, sum(gain)::BIGINT AS total FROM f JOIN b USING (feature) JOIN gains USING (bucket) GROUP BY r),
weighed AS (
  SELECT d.r, doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce((total - (total % n + n) % n) // n, 0) AS weight
  FROM d LEFT JOIN sums USING (r)),
scored AS (
  SELECT *, weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE)
    / 4294967296::DOUBLE)))::BIGINT AS score FROM weighed),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS n, count(*) OVER () AS eligible
  FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
  CASE WHEN n <= 25 * eligible // 100 THEN n END::BIGINT AS rank
FROM scored LEFT JOIN ranked USING (r)
"""
