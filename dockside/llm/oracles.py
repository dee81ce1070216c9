"""The queries that SQL can express, in SQL."""

from __future__ import annotations

_LETTERS = {w: "".join(f"[{c.upper()}{c}]" for c in w) for w in ("password", "passwd", "secret", "token", "api", "key")}
_KEYWORD = "|".join([*(_LETTERS[w] for w in ("password", "passwd", "secret", "token")), _LETTERS["api"] + "_?" + _LETTERS["key"]])
_QUOTE = """["'']?"""  # as an SQL literal has it
_ASSIGN = f"(?:{_KEYWORD}){_QUOTE} *[:=] *{_QUOTE}"
#: kind, expression, least length, expression of what that length leaves out
_KINDS = [
    ("assign", _ASSIGN + "[A-Za-z0-9+/_.=-]+", 8, "^" + _ASSIGN),
    ("access", "AKIA[A-Z0-9]+", 16, "^"),
    ("hex", "[0-9a-f]{32,}", 32, "^"),
    ("pem", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, "^"),
    ("github", "gh[po]_[A-Za-z0-9]{36,}", 0, "^"),
]


def _matches(rank: int, kind: str, pattern: str, least: int, head: str) -> str:
    stretch = f"(?s)(.*?)({pattern}|\\z)"
    return f"""
    SELECT n, '{kind}' AS kind, {rank} AS rank,
           (sum(length(gap) + length(hit)) OVER (PARTITION BY n ORDER BY i) - length(hit))::BIGINT AS s, hit, '{head}' AS head, {least} AS least
    FROM (SELECT n, unnest(range(len(g))) AS i, unnest(g) AS gap, unnest(h) AS hit
          FROM (SELECT n, regexp_extract_all(t, '{stretch}', 1) AS g, regexp_extract_all(t, '{stretch}', 2) AS h
                FROM d WHERE regexp_matches(t, '{pattern}')))"""


SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(_matches(k, *x) for k, x in enumerate(_KINDS))}),
f AS (SELECT n, kind, rank, s, kind || ':' || s || ':' || (s + length(hit)) AS span FROM m
      WHERE hit <> '' AND length(regexp_replace(hit, head, '')) >= least)
SELECT doc_id,
       count(*) FILTER (kind = 'assign') AS n_assign,
       count(*) FILTER (kind = 'access') AS n_access,
       count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY s, rank) FILTER (rank < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY s, rank), '') AS spans
FROM d LEFT JOIN f USING (n) GROUP BY n, doc_id
"""

URL_RULES = """
WITH rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                               ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
u AS (SELECT row_number() OVER () AS n, page_id,
             CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
k AS (SELECT n, page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM u),
s AS (SELECT n, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM k)
SELECT page_id, host, path,
       max_by(h || p, length(h) + length(p)) AS rule,
       coalesce(max_by(v, length(h) + length(p)), 'allow') AS verdict
FROM s LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY n, page_id, host, path
"""

_TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\p{Z}\s\x0B\x1C-\x1F\x{85}]"

#: A word's losses by the method: its count smoothed by the probability of its spelling, from byte trigrams of the corpus's words.
LM_SCORE = f"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t FROM documents),
dw AS (SELECT n, word, count(*) AS k FROM (SELECT n, unnest(regexp_extract_all(t, '{_TOKEN}')) AS word FROM d) GROUP BY ALL),
tw AS (SELECT word, count(*) AS k FROM (SELECT unnest(regexp_extract_all(text, '{_TOKEN}')) AS word FROM conversations) GROUP BY ALL),
v AS (SELECT word, sum(a)::DOUBLE AS a, sum(b)::DOUBLE AS b
      FROM (SELECT word, k AS a, 0 AS b FROM tw UNION ALL SELECT word, 0, k FROM dw) GROUP BY word),
s AS (SELECT word, '0A0A' || hex(encode(word)) || '0A' AS h FROM v),
s3 AS (SELECT word, substr(h, 2 * i + 1, 6) AS g FROM (SELECT word, h, unnest(range(length(h) // 2 - 2)) AS i FROM s)),
c AS (SELECT g, sum(a) AS a, sum(b) AS b FROM s3 JOIN v USING (word) GROUP BY g),
w AS (SELECT 'target' AS m, g, a AS c FROM c
      UNION ALL SELECT 'background', g, b * (SELECT CASE WHEN sum(a) > 0 AND sum(b) > 0 THEN sum(a) / sum(b) ELSE 1 END FROM c) FROM c),
one AS (SELECT m, right(g, 2) AS x, sum(c) AS c FROM w GROUP BY ALL),
p1 AS (SELECT m, x, (c + count(*) FILTER (c > 0) OVER (PARTITION BY m) / 256)
                    / (sum(c) OVER (PARTITION BY m) + count(*) FILTER (c > 0) OVER (PARTITION BY m)) AS p FROM one),
two AS (SELECT m, right(g, 4) AS y, sum(c) AS c FROM w GROUP BY ALL),
k2 AS (SELECT *, count(*) FILTER (c > 0) OVER (PARTITION BY m, left(y, 2)) AS k, sum(c) OVER (PARTITION BY m, left(y, 2)) AS s FROM two),
p2 AS (SELECT k2.m, y, CASE WHEN k > 0 THEN (c + k * p) / (s + k) ELSE p END AS p FROM k2 JOIN p1 ON p1.m = k2.m AND x = right(y, 2)),
k3 AS (SELECT *, count(*) FILTER (c > 0) OVER (PARTITION BY m, left(g, 4)) AS k, sum(c) OVER (PARTITION BY m, left(g, 4)) AS s FROM w),
p3 AS (SELECT g, max(-ln(CASE WHEN k > 0 THEN (c + k * p) / (s + k) ELSE p END)) FILTER (k3.m = 'target') AS a,
              max(-ln(CASE WHEN k > 0 THEN (c + k * p) / (s + k) ELSE p END)) FILTER (k3.m = 'background') AS b
       FROM k3 JOIN p2 ON p2.m = k3.m AND y = right(g, 4) GROUP BY g),
spelled AS (SELECT word, sum(a) AS a, sum(b) AS b FROM s3 JOIN p3 USING (g) GROUP BY word),
sums AS (SELECT sum(a) AS na, sum(b) AS nb, (count(*) FILTER (a > 0))::DOUBLE AS ka, (count(*) FILTER (b > 0))::DOUBLE AS kb,
                CASE WHEN sum(a) > 0 AND sum(b) > 0 THEN sum(a) / sum(b) ELSE 1 END AS scale FROM v),
loss AS (SELECT word, {{target}} AS a, {{background}} AS b FROM v JOIN spelled x USING (word), sums)
SELECT doc_id, coalesce(sum(k), 0)::BIGINT AS n_tokens, sum(k * a) / sum(k) AS target_loss, sum(k * b) / sum(k) AS background_loss,
       sum(k * a) / sum(k) - sum(k * b) / sum(k) AS score
FROM d LEFT JOIN dw USING (n) LEFT JOIN loss USING (word) GROUP BY n, doc_id
""".replace("{target}", "CASE WHEN ka = 0 THEN x.a WHEN v.a = 0 THEN ln(na + ka) - ln(ka) + x.a ELSE ln(na + ka) - ln(v.a + ka * exp(-x.a)) END").replace(
    "{background}", "CASE WHEN kb = 0 THEN x.b WHEN v.b = 0 THEN ln(nb * scale + kb) - ln(kb) + x.b ELSE ln(nb * scale + kb) - ln(v.b * scale + kb * exp(-x.b)) END"
)

_UPPER, _LOWER = (f"'{''.join(map(chr, range(a, a + 26)))}'" for a in (65, 97))

PHRASES = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
                       unnest(regexp_split_to_array(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[.,;:!?\\n-\\r]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS w FROM pieces),
g AS (SELECT lang, k, w[i:i + k - 1] AS w, count(*) AS f
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 5) AS r(k)) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, w, f AS a FROM g WHERE k > 1 AND f >= 30),
inside AS (SELECT lang, w[i:i + j - 1] AS w, max(a) AS around
           FROM (SELECT *, unnest(range(1, k - j + 2)) AS i FROM c, range(2, 4) AS r(j) WHERE j < k) GROUP BY ALL),
held AS (SELECT c.* FROM c LEFT JOIN inside USING (lang, w) WHERE around IS NULL OR 100 * around < 80 * a),
cut AS (SELECT *, unnest(range(1, k)) AS place FROM held),
scored AS (SELECT cut.lang, cut.w, cut.a, cut.place, x.f AS l, y.f AS r, (2000000::HUGEINT * cut.a // (x.f + y.f))::BIGINT AS score
           FROM cut JOIN g x ON x.lang = cut.lang AND x.w = cut.w[1:cut.place] JOIN g y ON y.lang = cut.lang AND y.w = cut.w[cut.place + 1:]),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, place) = 1),
ranked AS (SELECT lang, array_to_string(w, ' ') AS phrase, a, l, r, score,
                  row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ')) AS rank FROM weakest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

SPELLING = f"""
WITH RECURSIVE table_of AS (
    SELECT list_transform(range(256), lambda v: list_reduce(list_prepend(v, range(8)),
           lambda c, b: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t),
runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, run, count(*) AS m
         FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, {_UPPER}, {_LOWER}), '[a-z\u00C0-\u00FF]+')) AS run FROM documents)
         WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, m, xor(4294967295, list_reduce(
               list_prepend(4294967295, list_transform(range(octet_length(encode(id || ':' || run))), lambda i: ('0x' || substr(hex(encode(id || ':' || run)), 2 * i + 1, 2))::BIGINT)),
               lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) AS h FROM runs, table_of),
words AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, m FROM hashed),
v AS (SELECT word, sum(m)::BIGINT AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(m) >= 5),
gone AS (SELECT word, unnest(list_distinct(list_transform(range(length(word)), lambda i: left(word, i) || substr(word, i + 2)))) AS part FROM v),
slot AS (SELECT word, i, left(word, i) || '*' || substr(word, i + 2) AS part FROM (SELECT word, unnest(range(length(word))) AS i FROM v)),
pair AS (SELECT word, part AS near FROM gone WHERE part IN (SELECT word FROM v)
         UNION SELECT part, word FROM gone WHERE part IN (SELECT word FROM v)
         UNION SELECT a.word, b.word FROM slot a JOIN slot b USING (part) WHERE a.word <> b.word),
near AS (SELECT pair.word, count(*) AS n_near, arg_min(near, (-v.n, near)) AS form, max(v.n) AS form_n FROM pair JOIN v ON v.word = near GROUP BY pair.word),
f AS (SELECT v.word, CASE WHEN form_n >= 5 * n THEN form END AS form, n, coalesce(n_near, 0) AS n_near,
             CASE WHEN form_n >= 5 * n THEN form_n END AS form_n FROM v LEFT JOIN near USING (word)),
up(word, root) AS (SELECT word, word FROM f UNION ALL SELECT up.word, f.form FROM up JOIN f ON f.word = up.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, up.root, f.n, f.n_near, f.form_n
FROM f JOIN up ON up.word = f.word JOIN f last ON last.word = up.root AND last.form IS NULL
"""

ORACLES = {
    "op2_secrets": SECRETS, "op8_url_rules": URL_RULES, "op9_lm_score": LM_SCORE, "op11_phrases": PHRASES, "op12_spelling": SPELLING,
}
