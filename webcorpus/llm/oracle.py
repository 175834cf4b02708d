"""DuckDB SQL for the queries whose results SQL can express.

Each statement computes its query's columns from the tables in its own way.
The rest is tested against brute force, round trips or held-out labels.
"""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK_WORDS = r"[^\x20\x09-\x0D]+"
PLAIN_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, '{pattern}')"


def _lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


DECONTAMINATION = f"""
WITH doc AS (SELECT doc_id, {_words(_lower('text'), PLAIN_WORDS)} AS w FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words(_lower('text'), PLAIN_WORDS)} AS w FROM benchmark),
wanted AS (
  SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS words
  FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM item WHERE len(w) > 0)),
spot AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS words
  FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM doc, (SELECT DISTINCT size FROM wanted) WHERE len(w) >= size)),
hit AS (SELECT doc_id, item, spot.size, i FROM spot JOIN wanted USING (words, size)),
covered AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered ON covered.doc_id = doc.doc_id LEFT JOIN named ON named.doc_id = doc.doc_id
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE doc AS (SELECT doc_id, {_words(_lower('text'), BLANK_WORDS)} AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles, least(doc.doc_id, coalesce(b, doc.doc_id)) AS component_id,
       doc.doc_id <= coalesce(b, doc.doc_id) AS kept
FROM doc LEFT JOIN size ON size.doc_id = doc.doc_id LEFT JOIN least_of ON a = doc.doc_id
"""

REPEATED_PASSAGES = f"""
WITH doc AS (SELECT doc_id, {_words("coalesce(text, '')", BLANK_WORDS)} AS w FROM documents),
spot AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
         FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM doc WHERE len(w) >= 50)),
firsts AS (SELECT h, min(doc_id) AS f FROM spot GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM spot JOIN firsts USING (h) WHERE f < doc_id),
word AS (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS p FROM doc),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept ON kept.doc_id = doc.doc_id
"""

_SAID = "</s>[INST] ok [/INST]"


def _escaped(text: str) -> str:
    """The escape rule: backslashes doubled, then one put after the first character of each control string."""
    from webcorpus.llm.chat import CONTROL

    out = f"replace({text}, '\\', '\\\\')"
    for c in CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


def _chat() -> str:
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{_SAID}'), (-7, 1, 'assistant', '{_SAID}'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(length('<|im_start|>') + length({_escaped('role')}) + 1 + length({_escaped('text')}) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


def _secrets() -> str:
    """Matches and the pieces between them alternate here, too; the link is a plain range join of all parts."""
    from webcorpus.llm.secrets import WEAK

    scope = 240
    strong = {  # the base rules, written out
        "assign": (r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
        "access": ("(AKIA[A-Z0-9]+)", 16),
        "hex": ("([0-9a-f]{32,})", 32),
    }

    def java_to_re2(p: str) -> str:
        return p.replace("'", "''")

    kinds = " UNION ALL ".join(
        f"SELECT doc_id, '{k}' AS kind, {i} AS rank, {least} AS least, regexp_extract_all(t, '{java_to_re2(p)}', 0) AS m,"
        f" regexp_extract_all(t, '{java_to_re2(p)}', 1) AS g, regexp_split_to_array(t, '{java_to_re2(p)}') AS s FROM doc"
        for i, (k, (p, least)) in enumerate((strong | WEAK).items()))
    part = "CASE kind WHEN 'assign' THEN 'secret' WHEN 'hex' THEN 'secret' WHEN 'access' THEN 'identifier' ELSE kind END"
    return f"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({kinds}),
each AS (SELECT doc_id, kind, rank, least, m, g, s, unnest(generate_series(1, len(m))) AS i FROM found WHERE len(m) > 0),
spot AS (SELECT doc_id, kind, rank, least, length(coalesce(g[i], '')) AS value,
                CAST(list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a,
                length(m[i]) AS n FROM each),
part AS (SELECT doc_id, kind, rank, a, a + n AS e, kind IN ('assign', 'access', 'hex') AND value >= least AS strong, {part} AS part
         FROM spot WHERE value >= CASE WHEN kind IN ('assign', 'access', 'hex') THEN 4 ELSE least END),
base AS (SELECT doc_id, kind, rank, a, e FROM part WHERE strong),
weak AS (SELECT x.doc_id, x.part, x.a, x.e FROM part x JOIN part y
         ON x.doc_id = y.doc_id AND x.part <> y.part AND y.a < x.e + {scope} AND y.e > x.a - {scope}
         WHERE NOT x.strong GROUP BY ALL HAVING count(DISTINCT y.part) = 2),
spans AS (SELECT doc_id, kind, rank, a, e FROM base UNION ALL
          SELECT doc_id, 'linked_' || part, CASE part WHEN 'identifier' THEN 3 WHEN 'secret' THEN 4 ELSE 5 END, a, e FROM weak),
told AS (SELECT doc_id, string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, rank, e) AS spans FROM spans GROUP BY doc_id),
based AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                 count(*) FILTER (kind = 'hex') AS n_hex, string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, rank) AS spans FROM base GROUP BY doc_id)
SELECT doc.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(based.spans, '')) AS base_sha256, coalesce(told.spans, '') AS spans
FROM doc LEFT JOIN told ON told.doc_id = doc.doc_id LEFT JOIN based ON based.doc_id = doc.doc_id
"""


COLLOCATIONS = f"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_lower('text')}, '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
word AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM piece),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM word GROUP BY lang),
spot AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM word WHERE len(w) > 0),
f AS (SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
      FROM spot, (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE i + size - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
candidate AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE size > 1),
cut AS (SELECT lang, size, phrase, w, a, unnest(generate_series(1, size - 1)) AS k FROM candidate),
scored AS (
  SELECT cut.lang, cut.phrase, a, x.f AS l, y.f AS r, n, k,
         CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cut JOIN total USING (lang)
  JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_size AS (SELECT lang, w, size, a, unnest(generate_series(2, size - 1)) AS m FROM candidate WHERE size > 2),
inside AS (SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
           FROM (SELECT lang, w, m, a, unnest(generate_series(1, size - m + 1)) AS i FROM inner_size)),
around AS (SELECT lang, phrase, max(a) AS a FROM inside GROUP BY ALL),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN around USING (lang, phrase) WHERE around.a IS NULL OR 100 * around.a < 100 * lowest.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""


ORACLE = {
    "op2_decontamination": DECONTAMINATION,
    "op3_minhash_neardup": NEAR_DUPLICATES,
    "op4_secret_scans": _secrets(),
    "op6_substring_dedup": REPEATED_PASSAGES,
    "op7_chat_formatting": _chat(),
    "op12_collocations": COLLOCATIONS,
}
