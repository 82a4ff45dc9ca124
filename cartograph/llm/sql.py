"""DuckDB SQL for the registered text-corpus queries."""

import re

from cartograph.llm import mixing, urlfilter
from cartograph.llm.secrets import RULES

WORDS = r"[^\x20\x09-\x0D]+"


def _spans(rule) -> str:
    p = rule.pattern.replace("'", "''")
    return f"""
SELECT r, '{rule.name}' AS n, {[r.name for r in RULES].index(rule.name)} AS k,
       sum(length(gap) + length(hit)) OVER (PARTITION BY r ORDER BY i) - length(hit) AS s,
       sum(length(gap) + length(hit)) OVER (PARTITION BY r ORDER BY i) AS e, val
FROM (SELECT r, unnest(range(len(hits))) AS i, unnest(hits) AS hit, unnest(vals) AS val,
             unnest(gaps[1:len(hits)]) AS gap
      FROM (SELECT r, regexp_extract_all(t, '{p}') AS hits, regexp_extract_all(t, '{p}', {rule.group}) AS vals,
                   string_split_regex(t, '{p}') AS gaps FROM docs WHERE regexp_matches(t, '{p}')))"""


SECRETS = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS (""" + " UNION ALL ".join(f"SELECT * FROM ({_spans(r)}) WHERE length(val) >= {r.least}" for r in RULES) + """),
per AS (SELECT r, count(*) FILTER (WHERE n = 'assign') AS n_assign, count(*) FILTER (WHERE n = 'access') AS n_access,
               count(*) FILTER (WHERE n = 'hex') AS n_hex,
               string_agg(n || ':' || s || ':' || e, ',' ORDER BY s, k, e) FILTER (WHERE k < 3) AS base,
               string_agg(n || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS spans
        FROM found GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN per USING (r)"""

# CRC-32 bit by bit (DuckDB has no such function): 3988292384 is its reversed polynomial
CRC32 = """list_reduce(list_transform(range(0, 8 * strlen(t)), lambda i: (bytes[i // 8 + 1] >> (i % 8)) & 1),
  lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295)"""

# minimax by dynamic programming instead of the binary search; cuts as the operator lays them
SHARDS = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, coalesce(text, '') AS t,
         md5(coalesce(text, '')) AS h FROM documents),
grp AS (SELECT h, min(doc_id) AS ord, sum(size)::BIGINT AS gsize FROM base GROUP BY h),
ends AS (SELECT h, ord, gsize, sum(gsize) OVER (ORDER BY ord NULLS FIRST, h)::BIGINT AS pre FROM grp),
pos AS (SELECT pre FROM ends UNION ALL SELECT 0::BIGINT),
tot AS (SELECT max(pre) AS total FROM ends),
dp AS (SELECT 1 AS j, pre, pre AS cap FROM pos
       UNION ALL
       SELECT dp.j + 1, p.pre, min(greatest(dp.cap, p.pre - dp.pre)) FROM dp JOIN pos p ON dp.pre <= p.pre
       WHERE dp.j < 16 GROUP BY dp.j, p.pre),
cap AS (SELECT cap, total FROM dp, tot WHERE j = 16 AND pre = total),
early AS (SELECT 16 AS j, total AS low FROM tot
          UNION ALL
          SELECT e.j - 1, (SELECT min(p.pre) FROM pos p WHERE p.pre >= e.low - (SELECT cap FROM cap))
          FROM early e WHERE e.j > 1),
reach AS (SELECT j, low, pre AS cut, least(pre + cap, total) AS most,
                 least(greatest(CAST(round_even(j * total / 16.0, 0) AS BIGINT), low, pre), pre + cap, total) AS want
          FROM early, pos, cap),
cuts AS (SELECT 0 AS j, 0::BIGINT AS cut
         UNION ALL
         SELECT c.j + 1, (SELECT arg_min(p.pre, abs(p.pre - r.want) * 2 + (p.pre > r.want)::INT) FROM pos p
                          WHERE p.pre >= greatest(r.low, c.cut) AND p.pre <= r.most)
         FROM cuts c JOIN reach r ON r.j = c.j + 1 AND r.cut = c.cut WHERE c.j < 15),
bytes AS MATERIALIZED (
  SELECT h, any_value(t) AS t, list_transform(regexp_extract_all(any_value(hex(encode(t))), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes
  FROM base GROUP BY h),
crcs AS MATERIALIZED (SELECT h, xor({CRC32}, 4294967295) AS crc FROM bytes),
ranked AS (SELECT b.doc_id, b.size, b.h, g.ord, e.pre,
                  row_number() OVER (ORDER BY g.ord NULLS FIRST, g.h, b.doc_id NULLS FIRST) AS idx
           FROM base b JOIN grp g USING (h) JOIN ends e USING (h)),
placed AS (SELECT *, (SELECT count(*) FROM cuts WHERE j > 0 AND cut < pre) AS shard FROM ranked)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY idx) - 1 AS slot, NULL::INT AS grown_shard
FROM placed JOIN crcs USING (h)"""

_TOPIC = """CASE WHEN text IS NULL OR length(text) = 0 THEN 'empty' WHEN contains(text, ' | ') THEN 'table'
  WHEN NOT contains(text, chr(10)) THEN CASE WHEN length(text) < 600 THEN 'note' ELSE 'block' END
  WHEN length(text) < 2000 THEN 'article' ELSE 'book' END"""


def _rake_step(d: str) -> str:
    return f"CASE WHEN sum(w) OVER (PARTITION BY {d}) > 0 THEN w * t_{d} * total / sum(w) OVER (PARTITION BY {d}) ELSE w END"


MIXTURE = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, text, source, lang, {_TOPIC} AS topic,
         coalesce(len(regexp_extract_all(text, '{WORDS}')), 0)::BIGINT AS tokens FROM documents),
cell AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM docs GROUP BY ALL),
""" + ",\n".join(f"""g_{d} AS (SELECT {d}, t / sum(t) OVER () AS t_{d} FROM (
  SELECT {d}, CASE WHEN sum(tokens) > 0 THEN pow(sum(tokens), {mixing.SMOOTHING}) ELSE 0 END AS t FROM cell GROUP BY {d}))"""
                 for d in mixing.DIMS) + f""",
start AS (SELECT c.*, t_source, t_lang, t_topic, sum(tokens) OVER () AS total FROM cell c
          JOIN g_source a ON c.source IS NOT DISTINCT FROM a.source JOIN g_lang b ON c.lang IS NOT DISTINCT FROM b.lang
          JOIN g_topic g ON c.topic IS NOT DISTINCT FROM g.topic),
rake AS (SELECT 0 AS it, *, tokens AS w FROM start
         UNION ALL
         SELECT it + 1, source, lang, topic, tokens, t_source, t_lang, t_topic, total, {_rake_step('topic')} AS w FROM (
           SELECT * EXCLUDE (w), {_rake_step('lang')} AS w FROM (
             SELECT * EXCLUDE (w), {_rake_step('source')} AS w FROM rake WHERE it < 60))),
fac AS (SELECT source, lang, topic, tokens, w, total, CASE WHEN tokens > 0 THEN w / tokens END AS f FROM rake WHERE it = 60),
-- cells by falling factor: the first that is not whole at the scale that fills the share with those before it whole
fill AS (SELECT f, ({mixing.SHARE} * total - (sum(tokens) OVER (ORDER BY f DESC, source, lang, topic) - tokens))
                     / sum(w) OVER (ORDER BY f DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS c
         FROM fac WHERE tokens > 0 AND w > 0),
scale AS (SELECT max(c) FILTER (WHERE c * f < 1 AND f = top) AS c FROM fill, (SELECT max(f) FILTER (WHERE c * f < 1) AS top FROM fill)),
prob AS (SELECT source, lang, topic, CASE WHEN tokens = 0 THEN 1.0 WHEN c IS NULL THEN CASE WHEN f > 0 THEN 1.0 ELSE f END
                                          ELSE least(1.0, f * c) END AS prob FROM fac, scale)
SELECT doc_id, d.topic, d.tokens, round(prob, 6) AS prob,
       ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 12))::BIGINT
         / {float(16 ** 12)!r} < prob AS sampled
FROM docs d JOIN prob p ON d.source IS NOT DISTINCT FROM p.source AND d.lang IS NOT DISTINCT FROM p.lang
     AND d.topic IS NOT DISTINCT FROM p.topic"""

_COMPONENTS = """
reach AS (SELECT DISTINCT a AS node, a AS root FROM link
          UNION SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.node),
comp AS (SELECT node, min(root) AS component FROM reach GROUP BY node)"""

EMBEDDINGS = f"""
WITH RECURSIVE fine AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
normed AS (SELECT *, sqrt(list_dot_product(e, e)) AS n FROM fine),
link AS (SELECT x.r AS a, y.r AS b FROM normed x JOIN normed y ON x.label = y.label AND x.r <> y.r AND len(x.e) = len(y.e)
         WHERE list_dot_product(x.e, y.e) / (x.n * y.n) >= 0.98),
n AS (SELECT a AS r, count(*) AS n_links FROM link GROUP BY a),{_COMPONENTS},
least AS (SELECT component, min(vec_id) AS component_id FROM comp JOIN fine ON r = node GROUP BY component),
named AS (SELECT r, vec_id, component_id FROM fine LEFT JOIN comp ON node = r LEFT JOIN least USING (component)),
rows AS (SELECT vec_id, row_number() OVER () AS r0 FROM embeddings)
SELECT vec_id, n_links, component_id, coalesce(vec_id = component_id, false) AS kept FROM (
  SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id
  FROM named LEFT JOIN n USING (r)
  UNION ALL
  SELECT vec_id, 0, vec_id FROM embeddings
  WHERE NOT coalesce(label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false))"""

# every pair of texts that share a shingle, compared exactly
JACCARD = f"""
WITH RECURSIVE docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
cls AS (SELECT row_number() OVER () AS c, * FROM (SELECT t, min(doc_id) AS first_doc, count(*) AS copies FROM docs GROUP BY t)),
words AS (SELECT c, regexp_extract_all(lower(t), '[\\p{{L}}\\p{{N}}]+') AS w FROM cls),
sh AS (SELECT DISTINCT c, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                               ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
       FROM words WHERE len(w) > 0),
size AS (SELECT c, count(*) AS n FROM sh GROUP BY c),
meet AS (SELECT x.c AS a, y.c AS b, count(*) AS i FROM sh x JOIN sh y USING (s) WHERE x.c <> y.c GROUP BY ALL),
link AS (SELECT a, b FROM meet JOIN size p ON p.c = a JOIN size q ON q.c = b WHERE 9 * i >= 4 * (p.n + q.n)),
n AS (SELECT a AS c, sum(copies)::BIGINT AS links FROM link JOIN cls ON cls.c = b GROUP BY a),{_COMPONENTS},
named AS (SELECT cls.c, t, copies, first_doc, coalesce(component, cls.c) AS component FROM cls LEFT JOIN comp ON node = cls.c),
least AS (SELECT component, min(first_doc) AS class_id FROM named GROUP BY component)
SELECT doc_id, class_id, copies - 1 + coalesce(links, 0) AS n_links
FROM docs JOIN named USING (t) JOIN least USING (component) LEFT JOIN n USING (c)"""


def _glob_regex(glob: str) -> str:
    """A glob of urlfilter as a regular expression."""
    out, i = "", 0
    while i < len(glob):
        for token, form in (("**", ".*"), ("*", "[^/?]*"), ("?", "[^/]")):
            if glob.startswith(token, i):
                out, i = out + form, i + len(token)
                break
        else:
            if glob[i] == "[":
                end = glob.index("]", i)
                out, i = out + glob[i:end + 1].replace("[!", "[^"), end + 1
            else:
                i += glob[i] == "\\"
                out, i = out + re.escape(glob[i]), i + 1
    return out


def _first(cases: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in cases) + " END"


_HOST_RULES = sorted(urlfilter.HOST_RULES, key=lambda r: -len(r.host + r.path))
_GLOBS = [(r.pattern, r.verdict) for r in urlfilter.ranked().itertuples() if r.pattern]
_FITS = "(host = '{0.host}' OR ends_with(host, '.{0.host}')) AND starts_with(path, '{0.path}')"

URLS = f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{urlfilter.UPPER}', '{urlfilter.LOWER}') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
         coalesce(regexp_extract(url, '://[^/?#]*[^?#]*((\\?[^#]*)?)', 1), '') AS query FROM pages),
ruled AS (SELECT *, CASE WHEN host <> '' THEN '.' || host || path || query ELSE '' END AS canon,
                 {_first([(_FITS.format(r), f"'{r.host}{r.path}'") for r in _HOST_RULES])} AS rule FROM parts),
named AS (SELECT *, CASE WHEN rule IS NULL THEN
                 {_first([(f"regexp_full_match(canon, '{_glob_regex(g)}', 's')", f"'{g}'") for g, _ in _GLOBS])} END AS pattern FROM ruled)
SELECT page_id, host, path, rule, pattern, coalesce(
  {_first([(f"rule = '{r.host}{r.path}'", f"'{r.verdict}'") for r in _HOST_RULES])},
  {_first([(f"pattern = '{g}'", f"'{v}'") for g, v in _GLOBS])}, 'allow') AS verdict
FROM named"""

# near words by their texts without one letter, roots by recursion
VARIANTS = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS d, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{urlfilter.UPPER}', '{urlfilter.LOWER}') AS r
  FROM documents),
used AS (SELECT r, d || ':' || r AS t, count(*) AS uses FROM runs WHERE length(r) >= 5 GROUP BY ALL),
bytes AS (SELECT *, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes FROM used),
hashed AS (SELECT r, uses, xor({CRC32}, 4294967295) AS h FROM bytes),
words AS MATERIALIZED (
  SELECT word, sum(uses)::BIGINT AS n FROM (
    SELECT uses, CASE WHEN h % 97 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(uses) >= 3),
less AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT x.word, y.word AS other FROM less x JOIN less y USING (i, rest) WHERE x.word <> y.word
         UNION SELECT l.word, w.word FROM less l JOIN words w ON w.word = l.rest
         UNION SELECT w.word, l.word FROM less l JOIN words w ON w.word = l.rest),
best AS (SELECT near.word, count(*) AS n_near, max(n) AS most, min(other) FILTER (WHERE n = top) AS first FROM (
           SELECT near.word, other, n, max(n) OVER (PARTITION BY near.word) AS top FROM near JOIN words ON words.word = other) near GROUP BY ALL),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * n THEN first END AS form, CASE WHEN most >= 2 * n THEN most END AS form_n
          FROM words LEFT JOIN best USING (word)),
walk AS (SELECT word, form AS root FROM forms WHERE form IS NOT NULL
         UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.root WHERE forms.form IS NOT NULL),
ends AS (SELECT walk.word, root FROM walk JOIN forms ON forms.word = root WHERE form IS NULL)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM forms LEFT JOIN ends USING (word)"""
