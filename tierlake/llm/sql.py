"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from tierlake.llm.quality import FENCE, LENGTHS, MEASURES, MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW
from tierlake.llm.revisits import VISIT_PARAMS

_SPACE = r"[\x20\x09-\x0D]+"


def _bucket(v: str) -> str:
    drop = f"greatest(length(bin({v})) - 6, 0)"
    return f"(({v} >> {drop}) << {drop})"


def quality_measures(docs: str) -> str:
    """doc rows of ``docs`` (row id rid, doc_id, text, lang, source) with every measure."""
    return f"""
    w AS (SELECT rid, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda x: x <> '') AS w FROM {docs}),
    g AS (SELECT rid, i, list_aggregate(w[i:i + {WINDOW - 1}], 'string_agg', ' ') AS g
          FROM (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w WHERE len(w) >= {WINDOW})),
    hit AS (SELECT rid, i FROM g WHERE (rid, g) IN (SELECT (rid, g) FROM g GROUP BY rid, g HAVING count(*) > 1)),
    cov AS (SELECT rid, count(DISTINCT i + k)::BIGINT AS n_repeat_words
            FROM hit, range(0, {WINDOW}) AS r(k) GROUP BY rid),
    base AS (SELECT d.*, len(w.w)::BIGINT AS n_words,
               length(regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g'))::BIGINT AS word_chars,
               length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
               length(regexp_replace(coalesce(text, ''), '[^\\p{{Lu}}]+', '', 'g'))::BIGINT AS n_upper,
               length(regexp_replace(coalesce(text, ''), '[^!]+', '', 'g'))::BIGINT AS n_marks,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS li,
               coalesce(cov.n_repeat_words, 0)::BIGINT AS n_repeat_words
             FROM {docs} d JOIN w USING (rid) LEFT JOIN cov USING (rid)),
    measured AS (SELECT *, (len(li) - len(list_distinct(li)))::BIGINT AS n_dup_lines,
               (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed, len(li)::BIGINT AS n_lines,
               (1000 * n_symbols) // greatest(n_words, 1) AS symbol_rate,
               (1000 * (len(li) - len(list_distinct(li)))) // greatest(len(li), 1) AS dup_line_rate,
               (1000 * n_upper) // greatest(word_chars, 1) AS upper_rate,
               (1000 * n_marks) // greatest(n_words, 1) AS mark_rate,
               (1000 * word_chars) // greatest(n_words, 1) AS mean_word FROM base)"""


def quality_verdict() -> str:
    """CTEs from ``measured`` on; ends with ``judged``."""
    stacked = " UNION ALL ".join(
        f"SELECT lang, source, '{m}' AS measure, {_bucket(m)} AS value FROM measured WHERE NOT base_failed"
        for m in (*MEASURES, *LENGTHS))
    limits, tests = [], []
    at = lambda m, q: f"max(CASE WHEN measure = '{m}' THEN {q} END)"
    for m, (occurrences, length, below) in MEASURES.items():
        room = (f"greatest({FENCE} * ({at(m, 'q3')} - {at(m, 'q1')}), "
                f"{1000 * occurrences} // greatest({at(length, 'q2')}, 1))")
        limits.append(f"{at(m, 'q3')} + {room} AS {m}_hi")
        tests.append(f"{m} <= {m}_hi")
        if below:
            limits.append(f"{at(m, 'q1')} - {room} AS {m}_lo")
            tests.append(f"{m} >= {m}_lo")
    return f"""
    stacked AS ({stacked}),
    counted AS (SELECT lang, source, measure, value, count(*) AS n FROM stacked GROUP BY ALL),
    ranked AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY value) AS upto,
                      sum(n) OVER (PARTITION BY lang, source, measure) AS total FROM counted),
    quart AS (SELECT lang, source, measure, min(CASE WHEN 4 * upto >= total THEN value END) AS q1,
                     min(CASE WHEN 4 * upto >= 2 * total THEN value END) AS q2,
                     min(CASE WHEN 4 * upto >= 3 * total THEN value END) AS q3 FROM ranked GROUP BY ALL),
    limits AS (SELECT lang, source, {', '.join(limits)} FROM quart GROUP BY ALL),
    judged AS (SELECT m.*, coalesce(NOT base_failed AND {' AND '.join(tests)}, FALSE) AS kept
               FROM measured m LEFT JOIN limits l
               ON m.lang IS NOT DISTINCT FROM l.lang AND m.source IS NOT DISTINCT FROM l.source)"""


QUALITY = f"""WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, text, lang, source FROM documents),
{quality_measures('docs')},{quality_verdict()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
       {', '.join(MEASURES)} FROM judged"""


def _escaped(t: str) -> str:
    '''Length of ``t`` with backslashes doubled, '##' broken up and '</turn>' broken up.'''
    return (f"(length({t}) + length({t}) - length(replace({t}, chr(92), ''))"
            f" + length({t}) - length(regexp_replace({t}, '#(#+)', '#', 'g'))"
            f" + (length({t}) - length(replace({t}, '</turn>', ''))) // 7)")


_ORDER = "ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST"

REPLY_TREES = rf'''WITH planted(conv_id, turn, role, text) AS (
    VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
rows AS (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL UNION ALL SELECT * FROM planted),
clean AS (SELECT conv_id, turn, role, text, coalesce(role, '') AS r, coalesce(text, '') AS t FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(r || chr(10) || t || chr(10), '' {_ORDER})) AS turns_sha256,
    coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(t, '' {_ORDER}) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(14 + {_escaped('r')} + length(r) - length(replace(r, ':', '')) + {_escaped('t')})::BIGINT AS formatted_chars
FROM clean GROUP BY conv_id'''


def _canonical(url: str) -> str:
    bare = f"regexp_replace(trim({url}), '#.*$', '')"
    scheme = "^[A-Za-z][A-Za-z0-9+.-]*://"
    host = (f"regexp_replace(regexp_replace(lower(regexp_extract({bare}, '{scheme}([^/?]*)', 1)), '^www[0-9]*\\.', ''),"
            " ':(?:80|443)$', '')")
    rest = f"regexp_replace({bare}, '{scheme}[^/?]*', '')"
    rest = f"regexp_replace({rest}, '&{VISIT_PARAMS}=[^&]*', '', 'g')"
    rest = f"regexp_replace({rest}, '\\?{VISIT_PARAMS}=[^&]*&', '?')"
    rest = f"regexp_replace({rest}, '\\?{VISIT_PARAMS}=[^&]*$', '')"
    return f"{host} || regexp_replace({rest}, '/+$', '')"


WARC = f"""WITH p AS (SELECT *, {_canonical('url')} AS canonical, 1700000000 + (page_id % 997) * 3600 AS t0,
    '"' || substr(md5(html), 1, 16) || '"' AS tag FROM pages),
d AS (SELECT *, strftime(make_timestamp((t0 - (page_id % 89) * 60) * 1000000), '%a, %d %b %Y %H:%M:%S GMT') AS lm FROM p),
resp AS (SELECT canonical, t0 AS ts, max(page_id) AS pid FROM d GROUP BY ALL),
rev AS (
  SELECT page_id * 8 + 1 AS record_id, canonical, t0 + 86400 AS ts,
         CASE WHEN page_id % 2 = 0 THEN 'W/' ELSE '' END || tag AS etag, NULL AS lm, 'max-age=1200' AS cc, NULL AS ex, '0' AS cl FROM d
  UNION ALL SELECT page_id * 8 + 2, canonical, t0 + 172800, '"stale"', NULL, 'no-cache', NULL, NULL FROM d WHERE page_id % 3 = 0
  UNION ALL SELECT page_id * 8 + 3, canonical, t0 + 90000, NULL, lm, NULL, '0', NULL FROM d WHERE page_id % 5 = 0
  UNION ALL SELECT page_id * 8 + 4, canonical, t0 - 31536000, tag, NULL, NULL, NULL, NULL FROM d WHERE page_id % 7 = 0
  UNION ALL SELECT page_id * 8 + 5, canonical, t0 + 100000, NULL, NULL, 'private', NULL, NULL FROM d WHERE page_id % 11 = 0),
found AS (SELECT rev.*, resp.pid FROM rev ASOF LEFT JOIN resp ON rev.canonical = resp.canonical AND rev.ts > resp.ts),
judged AS (SELECT f.*, b.tag AS rtag, b.lm AS rlm, b.html,
    CASE WHEN pid IS NULL THEN 'orphan'
         WHEN f.etag IS NOT NULL THEN CASE WHEN regexp_replace(f.etag, '^W/', '') = b.tag THEN 'resolved' ELSE 'changed' END
         WHEN f.lm IS NOT NULL THEN CASE WHEN f.lm = b.lm THEN 'resolved' ELSE 'changed' END
         ELSE 'unverified' END AS status
  FROM found f LEFT JOIN d b ON b.page_id = f.pid),
merged AS (SELECT *, status = 'resolved' AS ok,
    strftime(make_timestamp(ts * 1000000), '%a, %d %b %Y %H:%M:%S GMT') AS date FROM judged)
SELECT record_id, canonical, ts, status, pid * 8 AS response_id,
    concat_ws(chr(10),
      'cache-control: ' || coalesce(cc, CASE WHEN ok THEN 'max-age=600' END),
      'content-length: ' || CASE WHEN ok THEN strlen(html)::VARCHAR ELSE cl END,
      CASE WHEN ok THEN 'content-type: text/html; charset=utf-8' END,
      'date: ' || date,
      'etag: ' || coalesce(etag, CASE WHEN ok THEN rtag END),
      'expires: ' || ex,
      'last-modified: ' || coalesce(lm, CASE WHEN ok THEN rlm END)) AS headers,
    CASE WHEN ok THEN length(html) END::BIGINT AS body_chars, CASE WHEN ok THEN md5(html) END AS body_md5
FROM merged"""

# CRC-32 of a string of digits, bit by bit (reflected, polynomial 0xEDB88320)
_BITS = "lambda c, i: xor(c >> 1, (c & 1) * 3988292384)"
_CRC = (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), "
        f"lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], {_BITS})), 4294967295)")

PREFIX_TRIE = rf"""WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER
    (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS nth
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, {_CRC} % 4 AS h, list(struct_pack(r := role, t := text) ORDER BY nth) AS turns FROM t GROUP BY conv_id),
seq AS (SELECT o.conv_id, coalesce(b.turns[:o.h], []) || o.turns[o.h + 1:] AS s
        FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
p AS (SELECT conv_id, s, d, s[:d] AS prefix FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM seq)),
node AS (SELECT d, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(s) = d), '')) AS ends_sha256,
    bool_and(len(s) = d) AS leaf,
    (count(*) - 1) * CASE WHEN d > 0 THEN len(regexp_extract_all(any_value(s[d].t), '[^ 	-
]+')) ELSE 0 END AS saved
    FROM p GROUP BY d, prefix),
up AS (SELECT DISTINCT a.d AS ad, a.prefix AS ap, b.d, b.prefix FROM node b, unnest(range(0, b.d + 1)) AS r(k)
       JOIN node a ON a.d = k AND a.prefix = b.prefix[:k]),
tree AS (SELECT ad, ap, count(*) FILTER (n.leaf) AS n_leaves, sum(n.saved) AS saved_tokens,
         count(*) FILTER (n.d = ad + 1) AS n_children
         FROM up JOIN node n ON n.d = up.d AND n.prefix = up.prefix GROUP BY ad, ap)
SELECT n.conv_id::BIGINT AS conv_id, n.d::BIGINT AS depth, m.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
    n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM node n JOIN tree ON ad = n.d AND ap = n.prefix LEFT JOIN node m ON m.d = n.d - 1 AND m.prefix = n.prefix[:n.d - 1]"""

ORACLE_SQL = {"op3_reply_trees": REPLY_TREES, "op5_quality_rules": QUALITY, "op10_warc": WARC,
              "op13_prefix_trie": PREFIX_TRIE}
