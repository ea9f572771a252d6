"""DuckDB statements for the queries that SQL can express."""

ORACLE: dict[str, str] = {}

# Windows of ten consecutive words (fewer for short items) of each benchmark item, found in the documents' words.
ORACLE["op10_decontaminate"] = r"""
WITH low AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bwin AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM items, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS r(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM bwin),
dwin AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM low, sizes, unnest(range(1, len(w) - n + 2)) AS r(i) WHERE len(w) >= n
), hit AS (SELECT d.doc_id, d.i, d.n, b.item_id FROM dwin d JOIN bwin b ON d.n = b.n AND d.win = b.win),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM hit, unnest(range(i, i + n)) AS r(k) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS h
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT l.doc_id, CAST(len(l.w) AS BIGINT) AS n_words, CAST(coalesce(words.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(f.n_items, 0) AS BIGINT) AS n_items, coalesce(f.h, sha256('')) AS items_sha256,
       coalesce(words.n_hit, 0) > 0 AS contaminated
FROM low l LEFT JOIN words USING (doc_id) LEFT JOIN found f USING (doc_id)
"""

# Jaccard similarity of five-word shingle sets, at least 0.8, over distinct sets; classes are connected components.
ORACLE["op9_ngram_join"] = r"""
WITH RECURSIVE low AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
  FROM low, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS r(i) WHERE len(w) > 0
), keyed AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, '|' ORDER BY s)) AS k FROM sh GROUP BY doc_id),
sets AS (SELECT k, min(doc_id) AS rep, any_value(n) AS n, count(*) AS copies FROM keyed GROUP BY k),
own AS (SELECT sets.rep, sh.s FROM sets JOIN sh ON sh.doc_id = sets.rep),
pairs AS (SELECT a.rep AS a, b.rep AS b, count(*) AS common FROM own a JOIN own b ON a.s = b.s AND a.rep <> b.rep GROUP BY a.rep, b.rep),
linked AS (
  SELECT p.a, p.b, y.copies FROM pairs p JOIN sets x ON x.rep = p.a JOIN sets y ON y.rep = p.b
  WHERE 10 * p.common >= 8 * (x.n + y.n - p.common)
), reach AS (
  SELECT rep AS a, rep AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN linked l ON l.a = r.b
), class AS (SELECT a AS rep, min(b) AS class_id FROM reach GROUP BY a),
links AS (SELECT a AS rep, sum(copies) AS n, count(*) AS texts FROM linked GROUP BY a)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id,
       CAST(coalesce(l.n, 0) + coalesce(s.copies - 1, 0) AS BIGINT) AS n_links, CAST(coalesce(l.texts, 0) AS BIGINT) AS n_text_links
FROM low d LEFT JOIN keyed k USING (doc_id) LEFT JOIN sets s ON s.k = k.k
LEFT JOIN class c ON c.rep = s.rep LEFT JOIN links l ON l.rep = s.rep
"""

# Poisson counts by inversion at a number hashed from seed, id and part; rates from the square roots of the sources' bytes.
ORACLE["op5_mixing"] = r"""
WITH sizes AS (SELECT source, sum(coalesce(strlen(text), 0)) AS bytes FROM documents GROUP BY source),
sums AS (SELECT sum(sqrt(bytes)) AS all_raw, sum(bytes) AS all_bytes FROM sizes),
rates AS (
  SELECT source, CASE WHEN bytes > 0 THEN round(sqrt(bytes) / all_raw * all_bytes / bytes, 6) ELSE 0.0 END AS rate FROM sizes, sums
), split AS (SELECT source, rate, greatest(1, CAST(ceil(rate / 32) AS BIGINT)) AS parts, rate / greatest(1, ceil(rate / 32)) AS mean FROM rates),
cdf AS (
  SELECT source, k, sum(exp(-mean) * pow(mean, k) / gamma(k + 1)) OVER (PARTITION BY source ORDER BY k) AS c
  FROM split, unnest(range(0, 1 + CAST(ceil(mean + 12 * sqrt(mean) + 20) AS BIGINT))) AS r(k)
), draws AS (
  SELECT d.*, s.rate, CAST(('0x' || substr(md5('20240501:' || CAST(d.doc_id AS VARCHAR) || ':' || CAST(j AS VARCHAR)), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u
  FROM documents d JOIN split s ON d.source IS NOT DISTINCT FROM s.source, unnest(range(1, s.parts + 1)) AS r(j)
), counts AS (
  SELECT doc_id, any_value(text) AS text, any_value(lang) AS lang, source, any_value(n_chars) AS n_chars, any_value(rate) AS rate,
         sum((SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM draws.source AND cdf.c <= draws.u)) AS copies
  FROM draws GROUP BY doc_id, source
)
SELECT doc_id, text, lang, source, n_chars, CAST(n AS INTEGER) AS copy_no, rate,
       md5('20240501:' || CAST(doc_id AS VARCHAR) || ':' || CAST(n AS VARCHAR) || ':order') AS shuffle_key
FROM counts, unnest(range(1, CAST(copies AS BIGINT) + 1)) AS r(n)
"""

# Equal payloads of 1000 bytes or more: the largest page_id is the response, the others revisit it.
ORACLE["op3_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
big AS (SELECT h, n, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY h, n)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.h AS payload_digest,
       CASE WHEN big.top IS NOT NULL AND p.page_id <> big.top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN big.top IS NOT NULL AND p.page_id <> big.top THEN big.top END AS refers_to
FROM p LEFT JOIN big ON p.h = big.h AND p.n = big.n
"""

# Every 100-byte string with the smallest (document, start) that has it; bytes of the later ones go.
ORACLE["op2_suffix_dedup"] = """
WITH raw AS (SELECT doc_id, encode(coalesce(text, '')) AS b, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
strings AS (SELECT doc_id, i, md5(b[i + 1:i + 100]) AS s FROM raw, unnest(range(0, n - 99)) AS r(i) WHERE n >= 100),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM strings) WHERE k > 1
), steps AS (
  SELECT doc_id, i, i + 100 AS e, max(i + 100) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM later
), marked AS (
  SELECT doc_id, i, e, sum(CASE WHEN before IS NULL OR i > before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM steps
), spans AS (SELECT doc_id, span, min(i) AS a, max(e) AS z FROM marked GROUP BY doc_id, span),
ordered AS (SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS last FROM spans),
pieces AS (
  SELECT o.doc_id, o.a, hex(r.b[o.last + 1:o.a]) AS h FROM ordered o JOIN raw r USING (doc_id) WHERE o.a > o.last
  UNION ALL
  SELECT m.doc_id, r.n, hex(r.b[m.z + 1:r.n]) FROM (SELECT doc_id, max(z) AS z FROM spans GROUP BY doc_id) m JOIN raw r USING (doc_id) WHERE r.n > m.z
), kept AS (SELECT doc_id, string_agg(h, '' ORDER BY a) AS h FROM pieces GROUP BY doc_id),
sums AS (SELECT doc_id, sum(z - a) AS removed, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT r.doc_id, r.n AS n_bytes, CAST(coalesce(s.removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(s.spans, 0) AS BIGINT) AS n_spans,
       CASE WHEN s.doc_id IS NULL THEN sha256(r.b) ELSE sha256(unhex(coalesce(k.h, ''))) END AS kept_sha256
FROM raw r LEFT JOIN sums s USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

# Quartiles are exact here: a sketch holds all its values up to 1024 documents.
_SIGNALS = (
    ("symbols_per_word", "n_symbols / greatest(n_words, 1)", 0.02, False),
    ("chars_per_word", "word_chars / greatest(n_words, 1)", 0.25, True),
    ("duplicate_lines", "n_dup_lines / greatest(n_lines, 1)", 0.1, False),
    ("repeated_words", "n_repeat_words / greatest(n_words, 1)", 0.06, False),
    ("upper_case", "n_upper / greatest(word_chars, 1)", 0.02, False),
)


def _quartiles(level: str, by: str) -> str:
    parts = ", ".join(f"quantile_disc({n}, 0.25) AS {n}_q1, quantile_disc({n}, 0.75) AS {n}_q3" for n, *_ in _SIGNALS)
    return f"{level} AS (SELECT {by + ', ' if by else ''}count(*) AS n, {parts} FROM ratios WHERE NOT base_failed{' GROUP BY ' + by if by else ''})"


def _outside(name: str, least: float, both: bool) -> str:
    def of(q):
        return f"CASE WHEN o.n >= 100 THEN o.{name}_{q} WHEN l.n >= 100 THEN l.{name}_{q} ELSE a.{name}_{q} END"
    reach = f"4.0::DOUBLE * greatest(({of('q3')}) - ({of('q1')}), {least}::DOUBLE)"
    low = f" OR r.{name} < ({of('q1')}) - {reach}" if both else ""
    return f"CASE WHEN r.{name} > ({of('q3')}) + {reach}{low} THEN '{name}' END"


ORACLE["op11_quality_rules"] = r"""
WITH texts AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
words AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts
), runs AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 7], ' ')) AS n
  FROM words, unnest(range(1, len(w) - 6)) AS r(i) WHERE len(w) >= 8
), repeated AS (SELECT doc_id, count(DISTINCT k) AS n FROM runs, unnest(range(i, i + 8)) AS r(k) WHERE runs.n > 1 GROUP BY doc_id),
counts AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(lines) AS BIGINT) AS n_lines, CAST(length(t) - length(regexp_replace(t, '\p{Lu}+', '', 'g')) AS BIGINT) AS n_upper
  FROM words LEFT JOIN repeated USING (doc_id)
), ratios AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, """ + ", ".join(f"{v} AS {n}" for n, v, *_ in _SIGNALS) + """
  FROM counts
), """ + ",\n".join([_quartiles("own", "lang, source"), _quartiles("of_lang", "lang"), _quartiles("of_all", "")]) + """
SELECT r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed,
       concat_ws(',', """ + ", ".join(_outside(n, least, both) for n, _, least, both in _SIGNALS) + """) AS failed_signals,
       NOT r.base_failed AND failed_signals = '' AS kept
FROM ratios r LEFT JOIN own o ON r.lang IS NOT DISTINCT FROM o.lang AND r.source IS NOT DISTINCT FROM o.source
  LEFT JOIN of_lang l ON r.lang IS NOT DISTINCT FROM l.lang, of_all a
"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _tree(name: str, leaves: str, by: str) -> str:
    """Nodes of every level of the trees of ``leaves(by, pos, d)``: ``name(by, level, pos, d, n)``."""
    return f"""{name}({by}, level, pos, d, n) AS (
  SELECT {by}, 0, pos, d, count(*) OVER (PARTITION BY {by}) FROM {leaves}
  UNION ALL SELECT {by}, level + 1, up, sha256(string_agg(d, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM (SELECT *, pos // 2 AS up FROM {name} WHERE n > 1) GROUP BY {by}, level, up
)"""


def _steps(name: str, leaves: str, tree: str, by: str) -> str:
    """For each leaf the ways up: its sibling with its side, or '-'."""
    return f"""{name} AS (
  SELECT l.{by}, l.pos, list(CASE WHEN s.d IS NULL THEN '-' WHEN s.pos % 2 = 0 THEN 'L' || s.d ELSE 'R' || s.d END ORDER BY o.level) AS way
  FROM {leaves} l JOIN {tree} o ON o.{by} IS NOT DISTINCT FROM l.{by} AND o.n > 1 AND o.pos = l.pos >> o.level
  LEFT JOIN {tree} s ON s.{by} IS NOT DISTINCT FROM l.{by} AND s.level = o.level AND s.pos = xor(o.pos, 1)
  GROUP BY l.{by}, l.pos
)"""


# crc32 of the id's digits, byte by byte; trees level by level; each proof folded from the leaf up.
ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE crc_bits(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) AS r(i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM crc_bits WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_bits WHERE k = 8),
crc(doc_id, digits, j, c) AS (
  SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR), 1, 4294967295::BIGINT FROM documents WHERE doc_id IS NOT NULL
  UNION ALL SELECT doc_id, digits, j + 1, xor(c // 256, t[xor(c % 256, ascii(digits[j])) + 1]) FROM crc, crc_table WHERE j <= length(digits)
), ids AS (SELECT doc_id, xor(c, 4294967295::BIGINT) % 7 = 0 AS tampered FROM crc WHERE j > length(digits)),
hashed AS (
  SELECT doc_id, lang, {_leaf('n_chars')} AS d, CASE WHEN tampered THEN {_leaf('(n_chars + 1)')} END AS forged FROM documents LEFT JOIN ids USING (doc_id)
), leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, d) - 1 AS pos FROM hashed),
{_tree("nodes", "leaves", "lang")},
subroots AS (SELECT 0 AS one, lang, d, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM nodes WHERE n = 1),
{_tree("tops", "subroots", "one")},
{_steps("low", "leaves", "nodes", "lang")},
{_steps("high", "subroots", "tops", "one")},
proofs AS (
  SELECT l.doc_id, l.d AS leaf, coalesce(l.forged, l.d) AS shown, s.d AS subroot, r.d AS root, list_concat(coalesce(low.way, []), coalesce(high.way, [])) AS way
  FROM leaves l LEFT JOIN low ON l.lang IS NOT DISTINCT FROM low.lang AND l.pos = low.pos
  JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang LEFT JOIN high ON s.pos = high.pos, (SELECT d FROM tops WHERE n = 1) r
), folded AS (
  SELECT *, list_reduce(list_prepend(shown, way), lambda acc, x: CASE x[1] WHEN 'L' THEN sha256(x[2:] || acc) WHEN 'R' THEN sha256(acc || x[2:])
                                                                        ELSE sha256(acc) END) AS folded_root FROM proofs
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(list_filter(way, lambda x: x <> '-'), lambda x: x[2:]), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded
"""
