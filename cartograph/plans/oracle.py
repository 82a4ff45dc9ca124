"""DuckDB SQL building blocks for the oracle side of every registered query.

The CTEs mirror :mod:`cartograph.sources.adapters` and the operators, written
independently in plain SQL over the driver's pre-registered tables.
"""

# Events adapter: typed log + split.
EV = """WITH ev AS (
  SELECT event_id, user_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS INTEGER) AS category_id,
         CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'fav' WHEN 'signup' THEN 'cart'
                         WHEN 'purchase' THEN 'buy' WHEN 'error' THEN 'error' ELSE event_type END AS behavior_type,
         CAST(floor(epoch(ts)) AS BIGINT) AS ts,
         CASE WHEN event_id % 4 <> 3 THEN 'train' ELSE 'test' END AS split
  FROM events)"""

CLEAN = EV + """,
clean AS (SELECT * FROM ev WHERE behavior_type IN ('pv', 'cart', 'fav', 'buy'))"""

DEEP = EV + """,
deep AS (SELECT * FROM ev WHERE behavior_type IN ('cart', 'fav', 'buy')),
edges AS (SELECT DISTINCT user_id, item_id FROM deep)"""

WEIGHT = ("CASE behavior_type WHEN 'buy' THEN 4 WHEN 'cart' THEN 3 WHEN 'fav' THEN 2 "
          "WHEN 'pv' THEN 1 ELSE 0 END")

USER_AGG = CLEAN + f""",
agg AS (SELECT user_id, max(ts) AS max_ts, count(*) AS activity_count,
               CAST(sum({WEIGHT}) AS DOUBLE) AS value_score
        FROM clean GROUP BY user_id)"""

FEATURES = USER_AGG + """,
feat AS (SELECT user_id, ((SELECT max(max_ts) FROM agg) - max_ts) / 86400.0 AS recency_days,
                activity_count, value_score FROM agg)"""

NORM = FEATURES + """,
b AS (SELECT min(recency_days) AS r0, max(recency_days) AS r1,
             min(CAST(activity_count AS DOUBLE)) AS a0, max(CAST(activity_count AS DOUBLE)) AS a1,
             min(value_score) AS v0, max(value_score) AS v1 FROM feat),
norm AS (
  SELECT user_id,
         round(CASE WHEN r1 = r0 THEN 0.5 ELSE (recency_days - r0) / (r1 - r0) END, 4) AS f1,
         round(CASE WHEN a1 = a0 THEN 0.5 ELSE (CAST(activity_count AS DOUBLE) - a0) / (a1 - a0) END, 4) AS f2,
         round(CASE WHEN v1 = v0 THEN 0.5 ELSE (value_score - v0) / (v1 - v0) END, 4) AS f3
  FROM feat, b)"""

PAIRS = DEEP + """,
pairs AS (SELECT a.user_id, a.item_id AS item_a, b.item_id AS item_b
          FROM edges a JOIN edges b ON a.user_id = b.user_id AND a.item_id < b.item_id),
cooc AS (SELECT item_a, item_b, count(*) AS n_users FROM pairs GROUP BY item_a, item_b)"""

RANK_TARGET = 1


def fixed(x: str, decimals: int) -> str:
    """Fixed-point text as a JVM prints it: half up on the shortest decimal text (``printf`` rounds the binary value)."""
    return f"CAST(CAST(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)) AS DECIMAL(38,{decimals})) AS VARCHAR)"


def mean(x: str) -> str:
    """Mean of four-decimal features, the same in any order of the rows."""
    return f"CAST(sum(CAST({x} AS DECIMAL(18,4))) AS DOUBLE) / count(*)"

# Bipartite graph, degrees and the walk as a recursive CTE (100 turns, full
# vectors), then the first turn whose L-inf change is below 1e-4.
GRAPH = DEEP + """,
bi AS (SELECT 0 AS src_kind, user_id AS src_id, 1 AS dst_kind, item_id AS dst_id FROM edges
       UNION ALL
       SELECT 1 AS src_kind, item_id AS src_id, 0 AS dst_kind, user_id AS dst_id FROM edges),
deg AS (SELECT src_kind AS kind, src_id AS id, count(*) AS out_deg FROM bi GROUP BY 1, 2),
nodes AS (SELECT src_kind AS kind, src_id AS id FROM bi UNION SELECT dst_kind, dst_id FROM bi),
wbi AS (SELECT bi.*, CAST(deg.out_deg AS DOUBLE) AS src_deg
        FROM bi JOIN deg ON bi.src_kind = deg.kind AND bi.src_id = deg.id)"""


def recursive(sql: str) -> str:
    assert sql.startswith("WITH ")
    return "WITH RECURSIVE " + sql[len("WITH "):]


def rank_walk(target: int = RANK_TARGET, max_iter: int = 100) -> str:
    return recursive(GRAPH) + f""",
walk(turn, kind, id, score) AS (
  SELECT 0, kind, id, CASE WHEN kind = 0 AND id = {target} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FROM nodes
  UNION ALL
  SELECT turn, kind, id, sum(rst) + 0.85::DOUBLE * sum(inc) FROM (
    SELECT p.turn + 1 AS turn, w.dst_kind AS kind, w.dst_id AS id, p.score / w.src_deg AS inc, 0.0::DOUBLE AS rst
    FROM walk p JOIN wbi w ON p.kind = w.src_kind AND p.id = w.src_id
    WHERE p.turn < {max_iter}
    UNION ALL
    SELECT p.turn + 1, p.kind, p.id, 0.0::DOUBLE,
           CASE WHEN p.kind = 0 AND p.id = {target} THEN 1.0::DOUBLE - 0.85::DOUBLE ELSE 0.0::DOUBLE END
    FROM walk p WHERE p.turn < {max_iter}
  ) GROUP BY turn, kind, id
),
chg AS (SELECT a.turn, max(abs(a.score - b.score)) AS change
        FROM walk a JOIN walk b ON a.kind = b.kind AND a.id = b.id AND a.turn = b.turn + 1
        GROUP BY a.turn),
stop AS (SELECT coalesce(min(turn) FILTER (WHERE change < 1e-4), {max_iter}) AS turn FROM chg),
final AS (SELECT w.kind, w.id, w.score FROM walk w JOIN stop ON w.turn = stop.turn)"""

# Walks of the N_TARGETS smallest users with deep edges, each stopped by its own change.
N_TARGETS = 20


def rank_walks(max_iter: int = 100) -> str:
    return recursive(GRAPH) + f""",
targets AS (SELECT DISTINCT user_id AS target FROM edges ORDER BY user_id LIMIT {N_TARGETS}),
walk(target, turn, kind, id, score) AS (
  SELECT target, 0, kind, id, CASE WHEN kind = 0 AND id = target THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FROM nodes, targets
  UNION ALL
  SELECT target, turn, kind, id, sum(rst) + 0.85::DOUBLE * sum(inc) FROM (
    SELECT p.target, p.turn + 1 AS turn, w.dst_kind AS kind, w.dst_id AS id, p.score / w.src_deg AS inc, 0.0::DOUBLE AS rst
    FROM walk p JOIN wbi w ON p.kind = w.src_kind AND p.id = w.src_id
    WHERE p.turn < {max_iter} AND p.score > 0
    UNION ALL
    SELECT p.target, p.turn + 1, p.kind, p.id, 0.0::DOUBLE,
           CASE WHEN p.kind = 0 AND p.id = p.target THEN 1.0::DOUBLE - 0.85::DOUBLE ELSE 0.0::DOUBLE END
    FROM walk p WHERE p.turn < {max_iter}
  ) GROUP BY target, turn, kind, id
),
chg AS (SELECT a.target, a.turn, max(abs(a.score - b.score)) AS change
        FROM walk a JOIN walk b ON a.target = b.target AND a.kind = b.kind AND a.id = b.id AND a.turn = b.turn + 1
        GROUP BY a.target, a.turn),
stop AS (SELECT target, coalesce(min(turn) FILTER (WHERE change < 1e-4), {max_iter}) AS turn FROM chg GROUP BY target),
final AS (SELECT w.target, w.kind, w.id, w.score FROM walk w JOIN stop ON w.target = stop.target AND w.turn = stop.turn)"""


# K-means over the rounded scaled features of training users (any train-split
# row counts, also an unknown behaviour); initial centres = the 3 smallest ids.
POINTS = NORM + """,
train_users AS (SELECT DISTINCT user_id FROM ev WHERE split = 'train'),
pts AS (SELECT user_id, f1, f2, f3 FROM norm WHERE user_id IN (SELECT user_id FROM train_users)),
init AS (SELECT CAST(row_number() OVER (ORDER BY user_id) - 1 AS INTEGER) AS cluster_id, f1, f2, f3
         FROM pts ORDER BY user_id LIMIT 3)"""


def _dist(p: str, c: str) -> str:
    return (f"sqrt(({p}.f1 - {c}.f1) * ({p}.f1 - {c}.f1) + ({p}.f2 - {c}.f2) * ({p}.f2 - {c}.f2)"
            f" + ({p}.f3 - {c}.f3) * ({p}.f3 - {c}.f3))")


def kmeans_loop(max_iter: int = 20, init: str = "init") -> str:
    return recursive(POINTS) + f""",
km(turn, cluster_id, f1, f2, f3) AS (
  SELECT 0, cluster_id, f1, f2, f3 FROM {init}
  UNION ALL
  SELECT c.turn + 1, c.cluster_id, coalesce(m.f1, c.f1), coalesce(m.f2, c.f2), coalesce(m.f3, c.f3)
  FROM km c LEFT JOIN (
    SELECT turn, cid, {mean('f1')} AS f1, {mean('f2')} AS f2, {mean('f3')} AS f3
    FROM (SELECT k2.turn, p.user_id, p.f1, p.f2, p.f3,
                 arg_min(k2.cluster_id, [{_dist('p', 'k2')}, k2.cluster_id]) AS cid
          FROM pts p, km k2 GROUP BY k2.turn, p.user_id, p.f1, p.f2, p.f3)
    GROUP BY turn, cid) m ON m.turn = c.turn AND m.cid = c.cluster_id
  WHERE c.turn < {max_iter}
),
shift AS (SELECT a.turn, max({_dist('a', 'b')}) AS shift
          FROM km a JOIN km b ON a.cluster_id = b.cluster_id AND a.turn = b.turn + 1 GROUP BY a.turn),
kstop AS (SELECT coalesce(min(turn) FILTER (WHERE shift < 1e-4), {max_iter}) AS turn FROM shift),
centres AS (SELECT km.cluster_id, km.f1, km.f2, km.f3 FROM km JOIN kstop ON km.turn = kstop.turn),
labels AS (SELECT p.user_id, arg_min(c.cluster_id, [{_dist('p', 'c')}, c.cluster_id]) AS cluster_id
           FROM pts p, centres c GROUP BY p.user_id)"""


# Fixed centres for the single-step queries: the two smallest ids' rows and a
# far-away centre that stays empty.
FAR_CENTRE = (5.0, 5.0, 5.0)
STEP_CENTRES = POINTS + f""",
c0 AS (SELECT cluster_id, f1, f2, f3 FROM init WHERE cluster_id < 2
       UNION ALL SELECT 2, {FAR_CENTRE[0]}::DOUBLE, {FAR_CENTRE[1]}::DOUBLE, {FAR_CENTRE[2]}::DOUBLE),
asg AS (SELECT p.user_id, p.f1, p.f2, p.f3, arg_min(c.cluster_id, [{_dist('p', 'c')}, c.cluster_id]) AS cluster_id
        FROM pts p, c0 c GROUP BY p.user_id, p.f1, p.f2, p.f3),
c1 AS (SELECT c0.cluster_id, coalesce(m.f1, c0.f1) AS f1, coalesce(m.f2, c0.f2) AS f2, coalesce(m.f3, c0.f3) AS f3
       FROM c0 LEFT JOIN (SELECT cluster_id, {mean('f1')} AS f1, {mean('f2')} AS f2,
                                 {mean('f3')} AS f3 FROM asg GROUP BY cluster_id) m
       ON m.cluster_id = c0.cluster_id)"""

# Text adapter: the events log rendered as lines, damaged by event_id % 20.
JTRIM = r"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def _jtrim(x: str) -> str:
    return JTRIM.format(x=x)


def _int_parse(x: str, typ: str) -> str:
    t = _jtrim(x)
    return f"CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+') THEN TRY_CAST({t} AS {typ}) END"


LINES = EV + """,
fields AS (SELECT event_id, split, CAST(user_id AS VARCHAR) AS u, CAST(item_id AS VARCHAR) AS i,
                  CAST(category_id AS VARCHAR) AS c, behavior_type AS b, CAST(ts AS VARCHAR) AS t FROM ev),
lines AS (
  SELECT event_id, split, CASE event_id % 20
    WHEN 0 THEN concat_ws(',', u, i, c, b)
    WHEN 1 THEN concat_ws(',', u, i, 'x', b, t)
    WHEN 2 THEN concat_ws(',', '1.5', i, c, b, t)
    WHEN 3 THEN concat_ws(',', u, i, c, ' ' || upper(b) || ' ', t)
    WHEN 4 THEN concat_ws(',', u, i, c, b, t, 'extra')
    WHEN 5 THEN concat_ws(',', u, i, '9999999999', b, t)
    WHEN 6 THEN 'user_id,item_id,category_id,behavior_type,timestamp'
    WHEN 7 THEN ''
    ELSE concat_ws(',', u, i, c, b, t) END AS value
  FROM fields),
data AS (SELECT split, value, string_split(value, ',') AS parts FROM lines
         WHERE NOT starts_with(value, 'user_id') AND """ + _jtrim("value") + """ <> ''),
typed AS (
  SELECT split, value, len(parts) AS n,
         """ + _int_parse("parts[1]", "BIGINT") + """ AS user_id,
         """ + _int_parse("parts[2]", "BIGINT") + """ AS item_id,
         """ + _int_parse("parts[3]", "INTEGER") + """ AS category_id,
         lower(""" + _jtrim("parts[4]") + """) AS behavior_type,
         """ + _int_parse("parts[5]", "BIGINT") + """ AS ts
  FROM data)"""


def parsed(require_category: bool = True) -> str:
    cat = " AND category_id IS NOT NULL" if require_category else ""
    return LINES + f""",
parsed AS (SELECT split, user_id, item_id, category_id, behavior_type, ts FROM typed
           WHERE n >= 5 AND user_id IS NOT NULL AND item_id IS NOT NULL AND ts IS NOT NULL{cat}),
rejected AS (SELECT value, CASE WHEN n < 5 THEN 'arity' ELSE 'number' END AS reason FROM typed
             WHERE NOT (n >= 5 AND user_id IS NOT NULL AND item_id IS NOT NULL AND ts IS NOT NULL{cat}))"""


def _over_text(sql: str, prefix: str, require_category: bool, table: str) -> str:
    """Re-base a query written over ``ev`` onto the parsed text lines."""
    assert sql.startswith(prefix)
    return parsed(require_category) + f""",
src AS (SELECT user_id, item_id, category_id, behavior_type, ts, split FROM parsed),
{table}""" + sql[len(prefix):]


_CLEAN_TAIL = "clean AS (SELECT * FROM src WHERE behavior_type IN ('pv', 'cart', 'fav', 'buy'))"
_DEEP_TAIL = ("deep AS (SELECT * FROM src WHERE behavior_type IN ('cart', 'fav', 'buy')),\n"
              "edges AS (SELECT DISTINCT user_id, item_id FROM deep)")

NORM_TEXT = _over_text(NORM, CLEAN, True, _CLEAN_TAIL)
PAIRS_TEXT = _over_text(PAIRS, DEEP, True, _DEEP_TAIL)


def rank_walk_text(target: int = RANK_TARGET) -> str:
    plain = "WITH " + rank_walk(target)[len("WITH RECURSIVE "):]
    return recursive(_over_text(plain, DEEP, False, _DEEP_TAIL))


def kmeans_loop_text() -> str:
    # features from the parsed text, training users from the clean train lines
    body = kmeans_loop()[len("WITH RECURSIVE "):]
    return recursive(_over_text("WITH " + body, CLEAN, True, _CLEAN_TAIL))


# Lineitem adapter: the same ``ev`` columns from customers x parts.
_LINEITEM_EV = """ev AS (
  SELECT l_orderkey AS event_id, o_custkey AS user_id, l_partkey AS item_id,
         CAST(l_partkey % 100 AS INTEGER) AS category_id,
         CASE l_returnflag WHEN 'A' THEN 'fav' WHEN 'N' THEN 'buy' WHEN 'R' THEN 'cart' ELSE 'unknown' END AS behavior_type,
         CAST(floor(epoch(l_shipdate)) AS BIGINT) AS ts,
         CASE WHEN l_orderkey % 4 <> 3 THEN 'train' ELSE 'test' END AS split
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def lineitem(sql: str) -> str:
    """A query written over the events adapter, over the lineitem adapter."""
    events = EV[len("WITH "):]
    assert events in sql
    return sql.replace(events, _LINEITEM_EV)


# K initial centres: the rows of the 3 smallest md5(user ':' seed).
SEEDED_INIT = """(SELECT CAST(row_number() OVER (ORDER BY md5(CAST(user_id AS VARCHAR) || ':42'), user_id) - 1 AS INTEGER) AS cluster_id,
                 f1, f2, f3 FROM pts QUALIFY cluster_id < 3)"""

# Feature lines with one kind of damage per user_id % 12.
FEATURE_LINES = NORM + f""",
ftext AS (SELECT user_id, CAST(user_id AS VARCHAR) AS u, {fixed('f1', 4)} AS a, {fixed('f2', 4)} AS b, {fixed('f3', 4)} AS c FROM norm),
flines AS (SELECT CASE user_id % 12
    WHEN 0 THEN u || ',' || a WHEN 1 THEN concat_ws(',', u, 'x', b, c) WHEN 2 THEN concat_ws(',', u, 'inf', b, c)
    WHEN 3 THEN concat_ws(',', u, 'nan', b, c) WHEN 4 THEN concat_ws(',', u, 'NaN', b, c)
    WHEN 5 THEN concat_ws(',', u, '-Infinity', b, c) WHEN 6 THEN concat_ws(',', u, a, b, c, 'extra')
    WHEN 7 THEN ' ' || u || ' , ' || a || ' ,' || b || ',' || c WHEN 8 THEN concat_ws(',', u || '.5', a, b, c)
    WHEN 9 THEN concat_ws(',', u, a, '-Inf', c) ELSE concat_ws(',', u, a, b, c) END AS value FROM ftext),
fparts AS (SELECT string_split(value, ',') AS p FROM flines WHERE len(string_split(value, ',')) >= 4)"""


def _double(x: str) -> str:
    t = f"trim({x})"
    return (f"CASE WHEN {t} IN ('NaN', 'Infinity', '+Infinity', '-Infinity') THEN TRY_CAST({t} AS DOUBLE) "
            f"WHEN lower(trim({t}, '+-')) IN ('nan', 'inf', 'infinity') THEN NULL ELSE TRY_CAST({t} AS DOUBLE) END")


DAMAGED_FEATURES = FEATURE_LINES + f""",
fvals AS (SELECT TRY_CAST(trim(p[1]) AS BIGINT) AS user_id, trim(p[1]) AS ut, {_double('p[2]')} AS f1, {_double('p[3]')} AS f2,
                 {_double('p[4]')} AS f3 FROM fparts)
SELECT user_id, """ + ", ".join(
    f"CASE WHEN isnan({f}) THEN 'NaN' WHEN isinf({f}) THEN CASE WHEN {f} > 0 THEN 'Infinity' ELSE '-Infinity' END "
    f"ELSE {fixed(f, 4)} END AS {f}" for f in ("f1", "f2", "f3")) + """
FROM fvals WHERE NOT contains(ut, '.') AND user_id IS NOT NULL AND f1 IS NOT NULL AND f2 IS NOT NULL AND f3 IS NOT NULL"""
