"""DuckDB SQL for those corpus queries that SQL can express, written from their contracts."""

from __future__ import annotations

CONTAMINATION = r"""
WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bk AS (SELECT item_id, w, least(len(w), 10) AS k FROM bw WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS t
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM bk)),
docwin AS (
  SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS t
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM dw, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
hit AS (SELECT r, i, k, item_id FROM docwin JOIN win USING (k, t)),
words AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM hit)) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

SUBSTRINGS = r"""
WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS t
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM dw WHERE len(w) >= 50)),
firsts AS (SELECT t, min(doc_id) AS low FROM win GROUP BY t HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 50)) AS p
  FROM win JOIN firsts USING (t) WHERE low < doc_id),
kept AS (
  SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS words
  FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM dw)
  ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(words, '')) AS kept_sha256
FROM dw LEFT JOIN kept USING (r)
"""


NEAR_DUPLICATES = r"""
WITH RECURSIVE dw AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM dw WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
common AS (
  SELECT a.r AS a, b.r AS b, count(*) AS c
  FROM sh a JOIN sh b ON a.s = b.s AND a.r <> b.r GROUP BY a.r, b.r),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b
  WHERE c >= 0.8 * (x.n + y.n - c)
  UNION ALL
  SELECT x.r, y.r FROM dw x JOIN dw y ON x.text = y.text AND x.r <> y.r
  WHERE len(x.w) = 0 AND len(y.w) = 0),
reach AS (
  SELECT r AS a, r AS b FROM dw
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
groups AS (SELECT a AS r, min(doc_id) AS class_id FROM reach JOIN dw ON dw.r = b GROUP BY a),
degrees AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT doc_id, class_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links
FROM dw JOIN groups USING (r) LEFT JOIN degrees USING (r)
"""


LINES = r"""
WITH l AS (
  SELECT r, doc_id, raw, no, trim(raw, ' ' || chr(9) || chr(13)) AS x
  FROM (SELECT r, doc_id, unnest(w) AS raw, unnest(range(len(w))) AS no
        FROM (SELECT row_number() OVER () AS r, doc_id, string_split(text, chr(10)) AS w
              FROM documents))),
d AS (
  SELECT x, length(x) AS n, min({'d': doc_id, 'n': no}) AS low FROM l
  WHERE length(x) >= 1 GROUP BY x),
k AS (
  SELECT x, n, low, m, 'first' AS side, left(x, m // 2) AS half
  FROM d, unnest([n, n - 1]) AS u(m) WHERE n >= 20
  UNION ALL
  SELECT x, n, low, m, 'last', right(x, m // 2) FROM d, unnest([n, n - 1]) AS u(m) WHERE n >= 20),
near AS (
  SELECT a.x, min(b.low) AS low FROM k a JOIN k b USING (m, side, half)
  WHERE a.x <> b.x AND m = least(a.n, b.n) AND levenshtein(a.x, b.x) <= 1 GROUP BY a.x),
cut AS (SELECT d.x, least(d.low, coalesce(near.low, d.low)) AS low FROM d LEFT JOIN near USING (x)),
marked AS (
  SELECT r, raw, no, cut.x IS NOT NULL AND {'d': doc_id, 'n': no} > cut.low AS gone
  FROM l LEFT JOIN cut USING (x)),
told AS (
  SELECT r, count(*) AS n_lines, count_if(gone) AS n_removed,
    coalesce(string_agg(raw, chr(10) ORDER BY no) FILTER (WHERE NOT gone), '') AS rest
  FROM marked GROUP BY r)
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE rest END AS text, lang, source, n_chars,
  CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
  CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
FROM (SELECT row_number() OVER () AS r, * FROM documents) LEFT JOIN told USING (r)
"""

MIXING = r"""
WITH s AS (SELECT source, count(*) AS n, sqrt(count(*)) AS weight FROM documents GROUP BY source),
rate AS (
  SELECT source, (SELECT count(*) FROM documents) * weight / (SELECT sum(weight) FROM s) / n AS rate
  FROM s),
steps AS (
  SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1)))
    OVER (PARTITION BY source ORDER BY k) AS below
  FROM (SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1))
          AS k FROM rate)),
named AS (
  SELECT *, coalesce(CAST(doc_id AS VARCHAR), 'null') AS id,
    count(*) OVER (PARTITION BY doc_id) AS n_rows,
    md5(coalesce(source, 'null') || ':' || coalesce(text, 'null')) AS content FROM documents),
told AS (
  SELECT *, CASE WHEN doc_id IS NOT NULL AND n_rows = 1 THEN id ELSE id || ':' || content || ':'
    || (row_number() OVER (PARTITION BY doc_id, content) - 1) END AS own FROM named),
u AS (
  SELECT *, CAST(('0x' || substr(md5('mix-1:' || own), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u
  FROM told),
drawn AS (
  SELECT *, (SELECT count(*) FROM steps WHERE steps.source IS NOT DISTINCT FROM u.source
             AND below <= u.u) AS times FROM u)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy
FROM (SELECT *, unnest(range(1, times + 1)) AS copy FROM drawn)
"""


_DIGITS = ", ".join(
    f"('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')[(v{i} >> {shift}) % 32 + 1]"
    for i in range(8)
    for shift in (15, 10, 5, 0)
)
_VALUES = ", ".join(
    f"CAST('0x' || substr(sha1(payload), {5 * i + 1}, 5) AS BIGINT) AS v{i}" for i in range(8)
)
ARCHIVES = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, payload, min(page_id) OVER (PARTITION BY payload) AS low, {_VALUES} FROM p)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  concat({_DIGITS}) AS payload_digest,
  CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = low THEN NULL ELSE low END AS refers_to
FROM d
"""


def _crc_table() -> list[int]:
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of a text's UTF-8 bytes."""
    byte = f"CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT)"
    octets = f"list_transform(range(0, strlen({text})), lambda i: {byte})"
    step = f"xor(c >> 8, ({_crc_table()})[xor(c, b) & 255 + 1])"
    step = step.replace("xor(c, b) & 255 + 1", "(xor(c, b) & 255) + 1")
    started = f"list_prepend(CAST(4294967295 AS BIGINT), {octets})"
    return f"xor(list_reduce({started}, lambda c, b: {step}), CAST(4294967295 AS BIGINT))"


SPELLING = rf"""
WITH RECURSIVE runs AS (
  SELECT prefix, x, count(*) AS n
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS prefix, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[A-Za-zÀ-ÿ]+')) AS x FROM documents)
  WHERE length(x) >= 6 GROUP BY ALL),
marked AS (SELECT x, n, {crc32("(prefix || x)")} AS h FROM runs),
spoilt AS (
  SELECT n, CASE WHEN h % 199 = 0 THEN left(x, h % length(x)) || substr(x, h % length(x) + 2)
    ELSE x END AS word FROM marked),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spoilt WHERE length(word) >= 6
  GROUP BY word HAVING sum(n) >= 5),
cuts AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b USING (rest, i)
  WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(n) AS most, min({{'n': -n, 'w': other}})['w'] AS other
  FROM near GROUP BY word),
told AS (
  SELECT word, CASE WHEN most >= 5 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN most >= 5 * n THEN most END AS form_n
  FROM words LEFT JOIN best USING (word)),
way AS (
  SELECT word, word AS root FROM told WHERE form IS NULL
  UNION ALL SELECT told.word, way.root FROM way JOIN told ON told.form = way.word)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM told JOIN way USING (word)
"""


def _least(*ways: tuple[str, int, str, str]) -> str:
    """SQL for the least of several ways: from a state, at a cost, by a letter, with a new line."""
    options = [
        f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {state}.o || {line}}}"
        for state, cost, letter, line in ways
    ]
    return f"list_sort([{', '.join(options)}])[1]"


_STAY = ("CAST([] AS VARCHAR[])",)
_USER, _ASSISTANT = "['user:']", "['assistant:']"


def _closed(source: str) -> str:
    """SQL for the ways of ``source`` after turns were inserted: ``u2`` and ``u3`` replace states."""
    user = _least(
        ("s2", 0, "", *_STAY), *((state, 3, "I", _USER) for state in ("s0", "s1", "s3"))
    )
    assistant = _least(("s3", 0, "", *_STAY), ("u2", 3, "I", _ASSISTANT))
    return f"(SELECT *, {assistant} AS u3 FROM (SELECT *, {user} AS u2 FROM ({source})))"


def _stayed(state: str, initial: str) -> tuple[str, str, str, str]:
    cost = f"CASE WHEN dead OR ini <> '{initial}' THEN 1000000 ELSE 3 * CAST(cut AS INT) END"
    return state, cost, "K", "[role || ':' || text]"


def _given(state: str, role: str) -> tuple[str, str, str, str]:
    cost = "CASE WHEN dead THEN 1000000 ELSE 3 + 3 * CAST(cut AS INT) END"
    return state, cost, "R", f"['{role}:' || text]"


def _deleted(state: str) -> tuple[str, int, str, str]:
    return state, 4, "D", *_STAY


_FROM = ["s0", "s1", "u3"]
REPAIR = rf"""
WITH RECURSIVE drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")}
      % 20 AS f
  FROM conversations),
spoilt AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM drawn WHERE f <> 0),
placed AS (
  SELECT *, left(role, 1) AS ini, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      md5(length(role) || ':' || role || text), copy) AS i,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS final FROM spoilt),
judged AS (
  SELECT *, final = '' AS blank,
    final <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair FROM placed),
faults AS (
  SELECT *, blank OR again AS dead, NOT blank AND NOT again AND final NOT IN ('.', '!', '?') AS cut
  FROM judged),
told AS (
  SELECT conv_id, count(*) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
    count_if(blank) AS blank, count_if(again) AS duplicate, count_if(cut) AS truncated,
    count_if(i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id),
ways AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': '', 'o': CAST([] AS VARCHAR[])}} AS s0,
    {{'c': 1000000, 'a': '', 'o': CAST([] AS VARCHAR[])}} AS s1,
    {{'c': 1000000, 'a': '', 'o': CAST([] AS VARCHAR[])}} AS s2,
    {{'c': 1000000, 'a': '', 'o': CAST([] AS VARCHAR[])}} AS s3 FROM told
  UNION ALL
  SELECT conv_id, i,
    {_least(_deleted("s0"))} AS s0,
    {_least(_deleted("s1"), _stayed("s0", "s"))} AS s1,
    {_least(_deleted("u2"), *(_stayed(s, "u") for s in _FROM), *(_given(s, "user") for s in _FROM))} AS s2,
    {_least(_deleted("u3"), _stayed("u2", "a"), _given("u2", "assistant"))} AS s3
  FROM {_closed("""SELECT ways.* EXCLUDE (i), faults.i, role, text, ini, dead, cut FROM ways
    JOIN faults ON ways.conv_id IS NOT DISTINCT FROM faults.conv_id AND faults.i = ways.i + 1""")}),
ends AS (
  SELECT conv_id, list_sort([s0, u3])[1] AS s
  FROM {_closed("""SELECT ways.* FROM ways
    JOIN told ON ways.conv_id IS NOT DISTINCT FROM told.conv_id AND i = n""")})
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps,
  CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
  CAST(coalesce(s.c, 0) AS BIGINT) AS cost, coalesce(s.a, '') AS audit,
  sha256(coalesce(array_to_string(s.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS ids
LEFT JOIN told ON ids.conv_id IS NOT DISTINCT FROM told.conv_id
LEFT JOIN ends ON ids.conv_id IS NOT DISTINCT FROM ends.conv_id
"""


def statements() -> dict[str, str]:
    return {
        "op7_warc_archives": ARCHIVES,
        "op6_line_dedup": LINES,
        "op9_source_mixing": MIXING,
        "op10_ngram_jaccard_join": NEAR_DUPLICATES,
        "op1_benchmark_contamination": CONTAMINATION,
        "op8_repeated_substrings": SUBSTRINGS,
        "op12_conversation_repair": REPAIR,
        "op13_spelling_variants": SPELLING,
    }
