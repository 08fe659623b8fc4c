"""DuckDB SQL for the queries that SQL can express.  Fixed values of the
contracts (rules, templates' texts, budgets) are inserted; all else is restated."""

from __future__ import annotations

from strata.llm import chat_format, license_scan, url_filter

SPACE = r"[\x20\x09-\x0D]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def license_sql() -> str:
    rows = ", ".join(f"({k}, {_quoted(name)}, {_quoted(text)})" for k, (name, text) in enumerate(license_scan.TEMPLATES))
    words = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
    return rf"""
WITH templates(k, license, body) AS (VALUES {rows}),
tc AS (SELECT k, license, word, count(*) AS n FROM (SELECT k, license, unnest({words.format('body')}) AS word FROM templates) GROUP BY ALL),
idf AS (SELECT word, ln((1 + (SELECT count(*) FROM templates)) / (1 + count(*))) + 1 AS idf FROM tc GROUP BY word),
unknown AS (SELECT ln(1 + count(*)) + 1 AS idf FROM templates),
tv AS (SELECT k, license, tc.word, n * idf AS x FROM tc JOIN idf USING (word)),
tn AS (SELECT k, sqrt(sum(x * x)) AS norm FROM tv GROUP BY k),
docs AS (SELECT doc_id, concat_ws('/', source, lang, doc_id::VARCHAR) AS path, coalesce(text, '') AS body FROM documents),
segments AS (SELECT doc_id, body, unnest(list_distinct([body] || regexp_split_to_array(body, '\r?\n|\r') || regexp_split_to_array(body, '\n\s*\n'))) AS segment FROM docs),
sc AS (SELECT doc_id, segment, segment = body AS whole, word, count(*) AS n
       FROM (SELECT doc_id, body, segment, unnest({words.format('segment')}) AS word FROM segments) GROUP BY ALL),
sv AS (SELECT doc_id, segment, whole, sc.word, n * coalesce(idf.idf, unknown.idf) AS x FROM sc LEFT JOIN idf ON idf.word = sc.word, unknown),
sn AS (SELECT doc_id, segment, sqrt(sum(x * x)) AS norm FROM sv GROUP BY ALL),
dots AS (SELECT doc_id, segment, whole, k, license, sum(sv.x * tv.x) AS dot FROM sv JOIN tv USING (word) GROUP BY ALL),
scored AS (SELECT doc_id, whole, license, round(dot / tn.norm / sn.norm, 6) AS score FROM dots JOIN tn USING (k) JOIN sn USING (doc_id, segment)),
own AS (SELECT doc_id, min({{'s': -score, 'l': license}}) AS best, bool_or(whole) AS whole FROM scored WHERE score >= {license_scan.THRESHOLD} GROUP BY doc_id),
files AS (SELECT d.doc_id, path, regexp_extract(path, '^(.*)/', 1) AS dir, best.l AS license, -best.s AS score, whole FROM docs d LEFT JOIN own USING (doc_id)),
licensed AS (SELECT dir AS above, min({{'s': -score, 'l': license, 'p': path}}) AS best FROM files WHERE license IS NOT NULL AND whole GROUP BY dir),
nearest AS (SELECT f.dir, max({{'n': length(above), 'l': best.l, 's': -best.s, 'a': above}}) AS hit
            FROM (SELECT DISTINCT dir FROM files) f JOIN licensed ON above = '' OR f.dir = above OR starts_with(f.dir, above || '/') GROUP BY f.dir)
SELECT doc_id, path, coalesce(license, hit.l) AS license, CASE WHEN license IS NOT NULL THEN score ELSE hit.s END AS score,
       CASE WHEN license IS NOT NULL THEN 'own' WHEN hit IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN license IS NULL THEN hit.a END AS license_dir
FROM files LEFT JOIN nearest USING (dir)"""


def url_sql() -> str:
    host = "coalesce(translate(regexp_extract({}, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"
    rules = ", ".join(f"({_quoted(v)}, {_quoted(h)}, {_quoted(p)})" for v, h, p in url_filter.RULES)
    d = url_filter.DAMPING

    def ranks(name: str, src: str, dst: str, weight: str) -> str:
        out = [f"{name}_fan AS (SELECT {src} AS src, {dst} AS dst, {d} / count(*) OVER (PARTITION BY {src}) AS share FROM edges)",
               f"{name}_0 AS (SELECT host, {weight} * {1 - d} AS score FROM shares WHERE {weight} > 0)"]
        for i in range(url_filter.ROUNDS):
            out.append(f"{name}_{i + 1} AS MATERIALIZED (SELECT host, sum(score) AS score FROM (SELECT * FROM {name}_0 UNION ALL "
                       f"SELECT dst, score * share FROM {name}_{i} JOIN {name}_fan ON host = src) GROUP BY host)")
        return ",\n".join(out)

    def guilt() -> str:
        out = ["guilt_0 AS (SELECT host, barred AS guilt FROM shares WHERE barred > 0)"]
        for i in range(url_filter.ROUNDS):
            out.append(f"guilt_{i + 1} AS MATERIALIZED (SELECT host, max(guilt) AS guilt FROM (SELECT * FROM guilt_0 UNION ALL "
                       f"SELECT src, sum(guilt * share) FROM guilt_{i} JOIN trust_fan ON host = dst GROUP BY src) GROUP BY host)")
        return ",\n".join(out)

    last = url_filter.ROUNDS
    least = (1 - d) * url_filter.MIN_SHARE * (1 - 1e-9)
    link, bare = (x.replace("'", "''") for x in (url_filter.LINK, url_filter.BARE_LINK))
    guilty = d * url_filter.MIN_SHARE * (1 - 1e-9)
    return rf"""
WITH rules(verdict, host, path) AS (VALUES {rules}),
urls AS (SELECT page_id, html, regexp_extract(url, '^(?s:(.*?))://', 1) AS scheme, {host.format('url')} AS host, coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
hits AS (SELECT u.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
         FROM urls u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path) GROUP BY u.page_id),
shares AS (SELECT host, avg((verdict IS NOT NULL AND verdict = 'allow')::INT) AS allowed, avg((verdict IS NOT NULL AND verdict = 'block')::INT) AS barred
           FROM urls LEFT JOIN hits USING (page_id) WHERE host <> '' GROUP BY host),
links AS (SELECT host AS src, unnest(regexp_extract_all(html, '{link}', 1) || list_transform(regexp_extract_all(html, '{bare}', 1), lambda x: scheme || ':' || x)) AS url FROM urls),
edges AS MATERIALIZED (SELECT DISTINCT src, {host.format('url')} AS dst FROM links WHERE src <> '' AND {host.format('url')} NOT IN ('', src)),
{ranks('trust', 'src', 'dst', 'allowed')},
{ranks('distrust', 'dst', 'src', 'barred')},
{guilt()},
blocked AS (SELECT g.host FROM guilt_{last} g LEFT JOIN trust_{last} t USING (host) WHERE g.host IN (SELECT src FROM edges)
            AND guilt >= {guilty!r} AND guilt * {1 - d!r} > coalesce(t.score, 0) UNION SELECT d.host FROM distrust_{last} d LEFT JOIN trust_{last} t USING (host) WHERE d.score > coalesce(t.score, 0) AND d.score >= {least!r})
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM urls LEFT JOIN hits USING (page_id)"""


JACCARD_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SPACE}'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                      ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS s
  FROM words),
classes AS (SELECT min(doc_id) AS c, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
items AS (SELECT c, n, unnest(s) AS item FROM classes),
pairs AS MATERIALIZED (
  SELECT a.c AS x, b.c AS y FROM items a JOIN items b USING (item) WHERE a.c < b.c
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
edges AS MATERIALIZED (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach(c, r) AS (SELECT c, c FROM classes UNION SELECT reach.c, edges.y FROM reach JOIN edges ON reach.r = edges.x),
component AS (SELECT c, min(r) AS component_id FROM reach GROUP BY c),
degree AS (SELECT x AS c, count(*) AS n_links FROM edges GROUP BY x)
SELECT doc_id, len(sets.s) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(n_links, 0) AS n_links
FROM sets LEFT JOIN classes USING (s) LEFT JOIN component USING (c) LEFT JOIN degree USING (c)"""


DEDUP_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


def chat_sql() -> str:
    said = r"\### Assistant: </turn> ok"
    esc = r"replace(replace(replace({}, '\', '\\'), '<', '\l'), '#', '\h')"
    return rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{said}' UNION ALL SELECT -7, 1, 'assistant', '{said}'),
counted AS (SELECT *, len(list_filter(regexp_split_to_array(body, '{SPACE}'), lambda w: w <> '')) + {chat_format.MARK_TOKENS} AS tokens,
  length('### ' || replace({esc.format('role')}, ':', '\c') || ': ' || {esc.format('body')} || '</turn>' || chr(10)) AS chars FROM turns),
placed AS (SELECT *, row_number() OVER o AS n, count(*) OVER (PARTITION BY conv_id) AS n_turns, sum(tokens) OVER o - tokens AS a,
                  first_value(role) OVER o = 'system' AS headed, first_value(tokens) OVER o AS first_tokens, first_value(chars) OVER o AS first_chars
           FROM counted WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
stepped AS (SELECT *, greatest(1, ({chat_format.BUDGET} - {chat_format.HISTORY} - CASE WHEN headed THEN first_tokens ELSE 0 END) // 2) AS step FROM placed),
dealt AS (SELECT *, (a // step) * 2 + (tokens > step)::INT AS w FROM stepped WHERE NOT (headed AND n = 1) OR n_turns = 1),
spans AS (SELECT conv_id, w, min(a) AS begins, any_value(headed AND n_turns > 1) AS headed, any_value(first_chars) AS first_chars FROM dealt GROUP BY conv_id, w),
nexts AS (SELECT *, lead(begins) OVER (PARTITION BY conv_id ORDER BY w) AS next_begins FROM spans),
sizes AS (SELECT d.conv_id, sum(d.chars * CASE WHEN next_begins - a <= {chat_format.HISTORY} THEN 2 ELSE 1 END) AS chars
          FROM dealt d JOIN nexts s ON d.conv_id IS NOT DISTINCT FROM s.conv_id AND d.w = s.w GROUP BY d.conv_id),
heads AS (SELECT conv_id, sum(CASE WHEN headed THEN first_chars ELSE 0 END) AS chars FROM spans GROUP BY conv_id),
said AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY n)) AS turns_sha256,
                coalesce(string_agg(body, '' ORDER BY n) FILTER (role = 'assistant'), '') AS taught FROM placed GROUP BY conv_id)
SELECT said.conv_id, n_turns, turns_sha256, length(taught) AS loss_chars, sha256(taught) AS loss_sha256, (sizes.chars + heads.chars)::BIGINT AS formatted_chars
FROM said JOIN sizes ON said.conv_id IS NOT DISTINCT FROM sizes.conv_id JOIN heads ON said.conv_id IS NOT DISTINCT FROM heads.conv_id"""


def repair_sql() -> str:
    """Damage, faults and the cheapest repair: a plain table of (cost, audit) per state, row by row."""
    crc = "SELECT range AS i, range AS c0 FROM range(256)"
    for k in range(8):
        crc = f"SELECT i, CASE WHEN c{k} & 1 = 1 THEN xor(c{k} >> 1, 3988292384) ELSE c{k} >> 1 END AS c{k + 1} FROM ({crc})"
    return rf"""
WITH RECURSIVE tab AS (SELECT list(c8 ORDER BY i) AS t FROM ({crc})),
base AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT),
                                lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS d FROM conversations, tab),
damaged AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
                   CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM base),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
faults AS (SELECT *, NOT regexp_matches(text, '[^ 	-
]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                  NOT regexp_matches(text, '[.!?][ 	-
]*$') AS cut, role[1] AS x, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS y FROM numbered),
kinds AS (SELECT *, CASE WHEN blank OR again THEN 2 WHEN cut THEN 1 ELSE 0 END AS status, CASE x WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 0 END AS initial FROM faults),
put(s, p) AS (VALUES (0, 2), (1, 2), (2, 3), (3, 2)),
led AS (SELECT s AS state, '' AS w, 0 AS cost, s AS here FROM put UNION ALL SELECT s, 'I', 5, p FROM put UNION ALL SELECT f.s, 'II', 10, g.p FROM put f JOIN put g ON g.s = f.p),
each AS (SELECT led.*, p, status, initial FROM led JOIN put ON put.s = led.here CROSS JOIN range(3) a(status) CROSS JOIN range(4) b(initial)),
moves AS (SELECT state, status, initial, w || 'D' AS word, cost + 2 AS cost, here AS target FROM each
          UNION ALL SELECT state, status, initial, w || 'R', cost + 1 + 5 * status, p FROM each WHERE status < 2
          UNION ALL SELECT state, status, initial, w || 'K', cost + 5 * status, initial FROM each WHERE status < 2 AND (initial = p OR (initial = 1 AND here = 0))),
dp AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, {{'c': 0, 'a': ''}} AS best FROM kinds
       UNION ALL SELECT d.conv_id, d.i + 1, target::INTEGER, min({{'c': (d.best.c + m.cost)::INTEGER, 'a': d.best.a || m.word}})
       FROM dp d JOIN kinds k ON k.conv_id IS NOT DISTINCT FROM d.conv_id AND k.i = d.i + 1 JOIN moves m ON m.state = d.state AND m.status = k.status AND m.initial = k.initial
       GROUP BY d.conv_id, d.i + 1, target),
ends AS (SELECT conv_id, min({{'c': best.c + CASE state WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END, 'a': best.a || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END}}) AS best
         FROM dp JOIN (SELECT conv_id AS c, max(i) AS n FROM kinds GROUP BY conv_id) ON c IS NOT DISTINCT FROM conv_id AND i = n GROUP BY conv_id),
edits AS (SELECT conv_id, unnest(string_split(best.a, '')) AS e, unnest(range(length(best.a))) AS pos FROM ends),
places AS (SELECT *, count_if(e <> 'I') OVER w AS i, count_if(e <> 'D') OVER w AS j FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
outs AS (SELECT p.conv_id, p.pos, e, j, CASE WHEN e = 'I' THEN '' ELSE text END AS text, role, x = 's' AND e = 'K' AS opens FROM places p
         JOIN kinds k ON k.conv_id IS NOT DISTINCT FROM p.conv_id AND k.i = greatest(p.i, 1) WHERE e <> 'D'),
roles AS (SELECT *, j - coalesce(max(opens::INT) OVER (PARTITION BY conv_id), 0) AS nth FROM outs),
texts AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN nth % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY pos) AS body FROM roles GROUP BY conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(again AND NOT blank) AS duplicate,
                  count_if(status = 1) AS truncated, count_if(i > 1 AND y || x NOT IN ('su', 'ua', 'au')) AS illegal FROM kinds GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM c.conv_id"""


PHRASE_SQL = r"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM texts),
words AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM words, range(1, 4) r(k)),
f AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL),
candidates AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10),
cuts AS (SELECT c.lang, c.k, c.phrase, a, cut, l.n AS l, r.n AS r, ((1000000::HUGEINT * a * a) // (l.n::HUGEINT * r.n))::BIGINT AS score
         FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
         JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:cut], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (SELECT lang, phrase, max(a) AS most FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM candidates WHERE k = 3) GROUP BY lang, phrase),
kept AS (SELECT s.* FROM scored s LEFT JOIN longer o ON s.k = 2 AND o.lang = s.lang AND o.phrase = s.phrase WHERE most IS NULL OR 100 * most < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


ORACLE: dict[str, str] = {
    "op1_license_scan": license_sql(),
    "op4_url_filter": url_sql(),
    "op5_jaccard_join": JACCARD_SQL,
    "op6_exact_dedup": DEDUP_SQL,
    "op9_chat_format": chat_sql(),
    "op12_conversation_repair": repair_sql(),
    "op13_phrase_mining": PHRASE_SQL,
}
