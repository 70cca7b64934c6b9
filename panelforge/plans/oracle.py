"""Oracle SQL (DuckDB dialect) for every registered query that SQL can express.

These are written independently of the Spark code: different formulations
where possible (``row_number`` instead of ``max_by``, ordered aggregates with
FILTER instead of ordered ``min_by``, ``PIVOT``, ``ASOF JOIN``, per-year
holiday construction instead of per-day predicates).
"""

from __future__ import annotations

from ..sources.bindings import SELECTED_ENTITIES


def _r(expr: str, digits: int = 4) -> str:
    """Rounding with the tie nudge the Spark side uses (see ``stable_round``)."""
    return f"round(({expr}) + {0.5 * 10.0 ** -(digits + 3)!r}, {digits})"


# ------------------------------------------------------------------ bindings

B1 = """
b1_base AS (
  SELECT CASE WHEN l_returnflag <> 'R' THEN l_returnflag || l_linestatus END AS ticker,
         l_suppkey AS permco,
         CAST(l_shipdate AS DATE) AS day,
         l_extendedprice AS dlyprc,
         l_extendedprice * l_quantity AS dlycap,
         nullif(l_discount, 0) AS dlyret,
         l_quantity AS dlyvol,
         l_tax AS shrout,
         l_orderkey * 8 + l_linenumber AS o1,
         l_partkey AS o2
  FROM lineitem),
b1_mkt AS (SELECT day, avg(dlyret) AS sprtrn FROM b1_base GROUP BY day),
b1 AS (SELECT b.*, m.sprtrn, strftime(b.day, '%Y-%m-%d') AS dlycaldt
       FROM b1_base b LEFT JOIN b1_mkt m USING (day))"""

B1_LABEL = """
b1_ranked AS (
  SELECT permco, ticker,
         row_number() OVER (PARTITION BY permco ORDER BY day DESC, o1 DESC, o2 DESC) AS rn
  FROM b1 WHERE ticker IS NOT NULL AND permco IS NOT NULL),
b1_label AS (
  SELECT k.permco, coalesce(nullif(trim(r.ticker), ''), 'unknown') AS label
  FROM (SELECT DISTINCT permco FROM b1 WHERE permco IS NOT NULL) k
  LEFT JOIN b1_ranked r ON r.permco = k.permco AND r.rn = 1)"""

FIELDS = ["dlyprc", "dlyret", "dlycap", "dlyvol", "shrout", "sprtrn"]

B1_FIRST = "b1_first AS (SELECT permco, day, " + ", ".join(
    f"first({f} ORDER BY o1, o2) FILTER (WHERE {f} IS NOT NULL) AS {f}" for f in FIELDS
) + " FROM b1 WHERE permco IS NOT NULL AND day IS NOT NULL GROUP BY permco, day)"

B2 = """
b2_obs AS (
  SELECT user_id AS id, CAST(ts AS DATE) AS timestamp, round(sum(value), 6) AS y,
         CAST(count(*) AS DOUBLE) AS x, CAST(count(*) FILTER (WHERE event_type = 'click') AS DOUBLE) AS z
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2),
b2_span AS (SELECT min(timestamp) AS lo, max(timestamp) AS hi FROM b2_obs
            WHERE y IS NOT NULL OR x IS NOT NULL OR z IS NOT NULL),
b2_grid AS (SELECT i.id, CAST(unnest(generate_series(s.lo, s.hi, INTERVAL 1 DAY)) AS DATE) AS timestamp
            FROM (SELECT DISTINCT id FROM b2_obs) i, b2_span s),
b2 AS (SELECT g.id, g.timestamp, o.y, o.x, o.z FROM b2_grid g LEFT JOIN b2_obs o USING (id, timestamp)),
b2_ctx AS (SELECT * FROM b2 WHERE timestamp BETWEEN DATE '2024-01-01' AND DATE '2024-01-23'),
b2_test AS (SELECT * FROM b2 WHERE timestamp BETWEEN DATE '2024-01-24' AND DATE '2024-01-30'),
b2_fut AS (SELECT id, timestamp, x, z FROM (
             SELECT *, row_number() OVER (PARTITION BY id ORDER BY timestamp) AS rn FROM b2_test)
           WHERE rn <= 7)"""

B3 = """
b3_obs AS (
  SELECT CAST(c.c_nationkey AS BIGINT) AS id, CAST(o.o_orderdate AS DATE) AS timestamp,
         round(sum(o.o_totalprice), 2) AS y
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2),
b3_span AS (SELECT min(timestamp) AS lo, max(timestamp) AS hi FROM b3_obs WHERE y IS NOT NULL),
b3_grid AS (SELECT i.id, CAST(unnest(generate_series(s.lo, s.hi, INTERVAL 1 DAY)) AS DATE) AS timestamp
            FROM (SELECT DISTINCT id FROM b3_obs) i, b3_span s),
b3 AS (SELECT g.id, g.timestamp, o.y FROM b3_grid g LEFT JOIN b3_obs o USING (id, timestamp)),
b3_ctx AS (SELECT * FROM b3 WHERE timestamp BETWEEN DATE '1995-01-01' AND DATE '1999-12-31')"""

LEVELS = "[0.1, 0.5, 0.9]"


def _q(p: str, q: str = "q", digits: int = 4) -> str:
    return (f"{_r(p, digits)} AS predictions, {_r(f'{p} + {q}[1]', digits)} AS q10, "
            f"{_r(f'{p} + {q}[2]', digits)} AS q50, {_r(f'{p} + {q}[3]', digits)} AS q90")


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)


# --------------------------------------------------------------- B1 queries

ENTITY_KEYS = "SELECT DISTINCT l_suppkey AS permco FROM lineitem WHERE l_suppkey IS NOT NULL"

LAST_LABEL = _with(B1, B1_LABEL) + "\nSELECT permco, label FROM b1_label"

FIRST_VALID_LONG = _with(B1, B1_FIRST) + "\nSELECT permco, day AS timestamp, " + ", ".join(
    f"{_r(f, 6)} AS {f}" for f in FIELDS) + " FROM b1_first"

def _dense(where: str) -> str:
    """First valid values on the calendar of the entities in ``where``."""
    return _with(
        B1, B1_LABEL, B1_FIRST,
        f"b1_in AS (SELECT * FROM b1_first WHERE {where})",
        "b1_bounds AS (SELECT min(day) AS lo, max(day) AS hi FROM b1_in WHERE " + " OR ".join(f"{x} IS NOT NULL" for x in FIELDS) + ")",
        "b1_grid AS (SELECT permco, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day "
        "FROM (SELECT DISTINCT permco FROM b1_in), b1_bounds)",
        "b1_dense AS (SELECT g.permco, l.label, g.day AS timestamp, " + ", ".join(f"{_r('f.' + x, 6)} AS {x}" for x in FIELDS)
        + " FROM b1_grid g LEFT JOIN b1_in f USING (permco, day) LEFT JOIN b1_label l USING (permco))")


PANEL_DENSE_LONG = _dense("true") + "\nSELECT * FROM b1_dense"

PANEL_WIDE_SELECTED = _dense(f"permco IN ({', '.join(map(str, SELECTED_ENTITIES))})") + "\n" + "\nUNION ALL ".join(
    f"SELECT timestamp, CAST(permco AS VARCHAR) || '_' || label || '_{x}' AS column_name, {x} AS value FROM b1_dense" for x in FIELDS)

_BLOCKS = _with(
    B1, B1_LABEL, B1_FIRST,
    "bi AS (SELECT permco, CAST(permco AS VARCHAR) || '_' || label AS stem, row_number() OVER (ORDER BY permco) - 1 AS i FROM b1_label)",
    "bm AS (" + "\nUNION ALL ".join(
        f"SELECT permco, CAST(i // 40 AS INTEGER) AS block, CAST(i % 40 * {len(FIELDS)} + {k} AS INTEGER) AS position, stem || '_{x}' AS column_name, "
        f"'{x}' AS field FROM bi" for k, x in enumerate(FIELDS)) + ")")

PANEL_MANIFEST = _BLOCKS + "\nSELECT block, position, column_name, permco AS entity, field FROM bm"

PANEL_BLOCKS = _BLOCKS + "\n" + "\nUNION ALL ".join(
    f"SELECT m.block, m.position, m.column_name, f.day AS timestamp, {_r('f.' + x, 6)} AS value FROM b1_first f JOIN bm m USING (permco) "
    f"WHERE m.field = '{x}' AND f.{x} IS NOT NULL" for x in FIELDS)

DUP_AND_NULL_CHECKS = _with(B1, """
per AS (
  SELECT permco, dlycaldt, count(*) AS r,
         count(*) FILTER (WHERE permco IS NOT NULL AND dlycaldt IS NOT NULL) AS n,
         count(*) FILTER (WHERE permco IS NULL OR dlycaldt IS NULL) AS nk,
         count(*) FILTER (WHERE dlycaldt IS NULL OR try_cast(dlycaldt AS DATE) IS NULL) AS nb
  FROM b1 GROUP BY permco, dlycaldt)""") + """
SELECT CAST(sum(r) AS BIGINT) AS n_rows, CAST(sum(nk) AS BIGINT) AS n_null_keys,
       CAST(sum(nb) AS BIGINT) AS n_bad_timestamps,
       CAST(coalesce(sum(CASE WHEN n > 1 THEN n - 1 END), 0) AS BIGINT) AS n_duplicate_keys,
       count(*) FILTER (WHERE n > 1) AS n_duplicate_groups
FROM per"""

CSV_ROUNDTRIP = _with(B1) + "\nSELECT ticker, permco, dlycaldt, " + ", ".join(
    f"{_r(f, 6)} AS {f}" for f in ["dlyprc", "dlycap", "dlyret", "dlyvol", "shrout", "sprtrn"]) + " FROM b1"

# --------------------------------------------------------------- B2 queries

PANEL_DENSIFIED = _with(B2) + "\nSELECT id, timestamp, y, x, z FROM b2"

SEASONAL = """
sn_last AS (SELECT id, max(timestamp) AS T FROM b2_ctx GROUP BY id),
sn_res AS (SELECT id, quantile_cont(y - ly, [0.1, 0.5, 0.9]) AS q FROM (
             SELECT id, y, lag(y, 7) OVER (PARTITION BY id ORDER BY timestamp) AS ly FROM b2_ctx)
           GROUP BY id),
sn_grid AS (SELECT l.id, r.k, CAST(l.T + CAST(r.k AS INTEGER) AS DATE) AS timestamp
            FROM sn_last l, range(1, 8) r(k)),
sn AS (SELECT g.id, g.timestamp, 'y' AS target_name, c.y AS p, s.q
       FROM sn_grid g
       LEFT JOIN b2_ctx c ON c.id = g.id
            AND c.timestamp = CAST(g.timestamp - 7 * CAST(ceil(g.k / 7.0) AS INTEGER) AS DATE)
       LEFT JOIN sn_res s ON s.id = g.id)"""


def _ols(prefix: str, unit: str, unit_src: str) -> str:
    """k=2 least squares per ``unit`` by residuals: z on x, y on x, then one residual on the other."""
    return f"""
{prefix}_cc AS (SELECT {unit_src} FROM b2_ctx c {'' if unit == 'id' else 'JOIN grp g USING (id)'}
               WHERE c.y IS NOT NULL AND c.x IS NOT NULL AND c.z IS NOT NULL),
{prefix}_s1 AS (SELECT u, regr_slope(z, x) AS zx, regr_intercept(z, x) AS zi, regr_slope(y, x) AS yx, regr_intercept(y, x) AS yi,
                var_pop(x) AS vx, var_pop(z) AS vz FROM {prefix}_cc GROUP BY u),
{prefix}_s2 AS (SELECT c.u, regr_slope(c.y - (s.yi + s.yx * c.x), c.z - (s.zi + s.zx * c.x)) AS b1,
                var_pop(c.z - (s.zi + s.zx * c.x)) AS vr FROM {prefix}_cc c JOIN {prefix}_s1 s USING (u) GROUP BY c.u),
{prefix}_pr AS (SELECT u, yx - b1 * zx AS b0, b1, yi - b1 * zi AS a FROM {prefix}_s1 JOIN {prefix}_s2 USING (u)
                WHERE vx > 0 AND vr > 1e-10 * vz),
{prefix}_all AS (SELECT c.*, {'c.id' if unit == 'id' else 'g.g'} AS u FROM b2_ctx c
                 {'' if unit == 'id' else 'JOIN grp g USING (id)'}),
{prefix}_res AS (SELECT a.u, quantile_cont(a.y - (p.a + p.b0 * a.x + p.b1 * a.z), [0.1, 0.5, 0.9]) AS q
                 FROM {prefix}_all a JOIN {prefix}_pr p USING (u) GROUP BY a.u),
{prefix} AS (SELECT f.id, f.timestamp, 'y' AS target_name, p.a + p.b0 * f.x + p.b1 * f.z AS p, r.q
             FROM (SELECT f.*, {'f.id' if unit == 'id' else 'g.g'} AS u FROM b2_fut f
                   {'' if unit == 'id' else 'JOIN grp g USING (id)'}) f
             LEFT JOIN {prefix}_pr p USING (u) LEFT JOIN {prefix}_res r USING (u))"""


GROUPS = """
grp AS (SELECT id, (dense_rank() OVER (ORDER BY id) - 1) // 100 AS g FROM (SELECT DISTINCT id FROM b2_ctx))"""

OLS = _ols("ols", "id", "c.id AS u, c.y, c.x, c.z")
POOLED = _ols("pool", "g", "g.g AS u, c.y, c.x, c.z")

FC_SEASONAL_NAIVE = _with(B2, SEASONAL) + f"\nSELECT id, timestamp, target_name, {_q('p')} FROM sn"
FC_COVARIATE_OLS = _with(B2, OLS) + f"\nSELECT id, timestamp, target_name, {_q('p')} FROM ols"
FC_POOLED_OLS = _with(B2, GROUPS, POOLED) + f"\nSELECT id, timestamp, target_name, {_q('p')} FROM pool"

# Two covariates of a (unit, step) by residuals: z of k days before on x, y on x, then one residual on the other.
FC_PAST_COVARIATES = _with(B2, """
dr AS (SELECT a.id, r.k, a.y, a.x, b.z FROM b2_ctx a CROSS JOIN range(1, 8) r(k)
       LEFT JOIN b2_ctx b ON b.id = a.id AND b.timestamp = CAST(a.timestamp - CAST(r.k AS INTEGER) AS DATE)),
dc AS (SELECT * FROM dr WHERE y IS NOT NULL AND x IS NOT NULL AND z IS NOT NULL),
d1 AS (SELECT id, k, regr_slope(z, x) AS zx, regr_intercept(z, x) AS zi, regr_slope(y, x) AS yx, regr_intercept(y, x) AS yi,
              var_pop(x) AS vx, var_pop(z) AS vz FROM dc GROUP BY id, k),
d2 AS (SELECT c.id, c.k, regr_slope(c.y - (s.yi + s.yx * c.x), c.z - (s.zi + s.zx * c.x)) AS b1,
              var_pop(c.z - (s.zi + s.zx * c.x)) AS vr FROM dc c JOIN d1 s USING (id, k) GROUP BY c.id, c.k),
dp AS (SELECT id, k, yx - b1 * zx AS b0, b1, yi - b1 * zi AS a FROM d1 JOIN d2 USING (id, k) WHERE vx > 0 AND vr > 1e-10 * vz),
dq AS (SELECT c.id, c.k, quantile_cont(c.y - (p.a + p.b0 * c.x + p.b1 * c.z), [0.1, 0.5, 0.9]) AS q
       FROM dc c JOIN dp p USING (id, k) GROUP BY c.id, c.k),
dt AS (SELECT id, max(timestamp) AS T, arg_max(coalesce(z, 'nan'), timestamp) AS z FROM b2_ctx GROUP BY id),
dg AS (SELECT d.id, r.k, CAST(d.T + CAST(r.k AS INTEGER) AS DATE) AS timestamp, CASE WHEN NOT isnan(d.z) THEN d.z END AS z
       FROM dt d CROSS JOIN range(1, 8) r(k)),
df AS (SELECT g.id, g.timestamp, p.a + p.b0 * f.x + p.b1 * g.z AS p, q.q
       FROM dg g LEFT JOIN b2_fut f USING (id, timestamp) LEFT JOIN dp p USING (id, k) LEFT JOIN dq q USING (id, k))""") + f"""
SELECT id, timestamp, 'y' AS target_name, {_q('p')} FROM df"""

# Scaled series, lags 1 and 7 pooled per batch, forecast step by step.
FC_POOLED_AR = _with(B2, GROUPS, """
ac AS (SELECT id, nullif(avg(abs(y)), 0) AS c, avg(y) AS m, max(timestamp) AS T FROM b2_ctx GROUP BY id),
al AS (SELECT b.id, g.g AS u, b.y / c.c AS y, lag(b.y / c.c, 1) OVER w AS x, lag(b.y / c.c, 7) OVER w AS z
       FROM b2_ctx b JOIN ac c USING (id) JOIN grp g USING (id) WINDOW w AS (PARTITION BY b.id ORDER BY b.timestamp)),
aw AS (SELECT * FROM al WHERE y IS NOT NULL AND x IS NOT NULL AND z IS NOT NULL),
a1 AS (SELECT u, regr_slope(z, x) AS zx, regr_intercept(z, x) AS zi, regr_slope(y, x) AS yx, regr_intercept(y, x) AS yi,
              var_pop(x) AS vx, var_pop(z) AS vz FROM aw GROUP BY u),
a2 AS (SELECT c.u, regr_slope(c.y - (s.yi + s.yx * c.x), c.z - (s.zi + s.zx * c.x)) AS b1,
              var_pop(c.z - (s.zi + s.zx * c.x)) AS vr FROM aw c JOIN a1 s USING (u) GROUP BY c.u),
ap AS (SELECT u, yx - b1 * zx AS b0, b1, yi - b1 * zi AS a FROM a1 JOIN a2 USING (u) WHERE vx > 0 AND vr > 1e-10 * vz),
aq AS (SELECT c.u, quantile_cont(c.y - (p.a + p.b0 * c.x + p.b1 * c.z), [0.1, 0.5, 0.9]) AS q FROM aw c JOIN ap p USING (u) GROUP BY c.u),
ah AS (SELECT b.id, CAST(b.timestamp - c.T AS INTEGER) AS back, coalesce(b.y, c.m) / c.c AS v FROM b2_ctx b JOIN ac c USING (id)),
ai AS (SELECT h.id, h.back, h.v, g.g AS u FROM ah h JOIN grp g USING (id) WHERE h.back > -7)""").replace("WITH ", "WITH RECURSIVE ", 1) + f""",
ar AS (SELECT id, u, 0 AS k, v AS p FROM ai WHERE back = 0
       UNION ALL
       SELECT r.id, r.u, r.k + 1, p.a + p.b0 * r.p + p.b1 * h.v
       FROM ar r LEFT JOIN ap p ON p.u = r.u LEFT JOIN ai h ON h.id = r.id AND h.back = r.k - 6 WHERE r.k < 7)
SELECT r.id, CAST(c.T + r.k AS DATE) AS timestamp, 'y' AS target_name, {_r('r.p * c.c')} AS predictions,
       {_r('r.p * c.c + q.q[1] * c.c')} AS q10, {_r('r.p * c.c + q.q[2] * c.c')} AS q50, {_r('r.p * c.c + q.q[3] * c.c')} AS q90
FROM ar r JOIN ac c USING (id) LEFT JOIN aq q ON q.u = r.u WHERE r.k > 0"""

COMBINED = """
comb AS (
  SELECT id, timestamp, target_name, p, q, 'no_covariates' AS model FROM sn
  UNION ALL SELECT id, timestamp, target_name, p, q, 'with_covariates' FROM ols
  UNION ALL SELECT id, timestamp, target_name, p, q, 'with_covariates_cross_learning' FROM pool)"""

_COMB = (B2, SEASONAL, OLS, GROUPS, POOLED, COMBINED)

FC_COMBINED = _with(*_COMB) + f"\nSELECT id, timestamp, target_name, {_q('p')}, model FROM comb"

SCORED = """
jt AS (SELECT c.model, c.p, t.y FROM comb c JOIN b2_test t USING (id, timestamp) WHERE c.target_name = 'y'),
sc AS (
  SELECT model, count(*) AS n,
         count(*) FILTER (WHERE y IS NULL OR p IS NULL) AS bad,
         count(*) FILTER (WHERE y IS NOT NULL AND p IS NOT NULL) AS n_valid,
         avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae,
         avg(abs((y - p) / nullif(y, 0))) * 100 AS mape,
         sum((y - p) * (y - p)) AS sse,
         var_pop(CASE WHEN p IS NOT NULL THEN y END) * count(CASE WHEN p IS NOT NULL THEN y END) AS sst
  FROM jt GROUP BY model)"""

SCORE_BY_MODEL = _with(*_COMB, SCORED) + """
SELECT model, n,
       """ + _r("CASE WHEN bad > 0 THEN NULL ELSE mse END", 6) + """ AS MSE,
       """ + _r("CASE WHEN bad > 0 THEN NULL ELSE mae END", 6) + """ AS MAE,
       """ + _r("CASE WHEN bad > 0 THEN NULL ELSE sqrt(mse) END", 6) + """ AS RMSE,
       """ + _r("mape", 6) + """ AS MAPE,
       """ + _r("CASE WHEN bad > 0 THEN NULL ELSE 1 - sse / nullif(sst, 0) END", 6) + """ AS R2
FROM sc"""

SCORE_BY_MODEL_SKIP = _with(*_COMB, SCORED) + """
SELECT model, n, n_valid, """ + _r("mse", 6) + " AS MSE, " + _r("mae", 6) + " AS MAE, " + _r("sqrt(mse)", 6) \
    + " AS RMSE, " + _r("mape", 6) + " AS MAPE, " + _r("1 - sse / nullif(sst, 0)", 6) + """ AS R2
FROM sc"""

SCORE_LONG = _with(*_COMB, SCORED, """
wide AS (
SELECT model,
       CASE WHEN bad > 0 THEN NULL ELSE mse END AS MSE,
       CASE WHEN bad > 0 THEN NULL ELSE mae END AS MAE,
       CASE WHEN bad > 0 THEN NULL ELSE sqrt(mse) END AS RMSE,
       mape AS MAPE,
       CASE WHEN bad > 0 THEN NULL ELSE 1 - sse / nullif(sst, 0) END AS R2
FROM sc)""") + """
SELECT model, metric, """ + _r("value", 6) + """ AS value
FROM wide UNPIVOT INCLUDE NULLS (value FOR metric IN (MSE, MAE, RMSE, MAPE, R2))"""

PLOT_FRAME = _with(*_COMB, """
hist AS (SELECT id, timestamp, y FROM (
           SELECT *, row_number() OVER (PARTITION BY id ORDER BY timestamp DESC) AS rn FROM b2_ctx)
         WHERE rn <= 14),
cut AS (SELECT id, min(timestamp) AS c FROM hist GROUP BY id),
fc AS (SELECT m.* FROM comb m JOIN cut USING (id) WHERE m.target_name = 'y' AND m.timestamp >= cut.c),
models AS (SELECT * FROM (VALUES ('no_covariates'), ('with_covariates'),
                                 ('with_covariates_cross_learning')) v(model))""") + """
SELECT h.id, h.timestamp, 'history' AS series, """ + _r("h.y") + """ AS value,
       CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper, m.model
FROM hist h, models m
UNION ALL
SELECT t.id, t.timestamp, 'truth', """ + _r("t.y") + """, NULL, NULL, f.model
FROM b2_test t JOIN (SELECT DISTINCT id, timestamp, model FROM fc) f USING (id, timestamp)
UNION ALL
SELECT id, timestamp, 'forecast', """ + _r("p") + ", " + _r("p + q[1]") + ", " + _r("p + q[3]") + """, model FROM fc"""

PLOT_FRAME_ONE = f"SELECT * FROM ({PLOT_FRAME}) WHERE id = 7"

FC_APPLY_MODEL = _with(B2, """
am_last AS (SELECT id, max(timestamp) AS T FROM b2_ctx GROUP BY id),
am_wm AS (SELECT id, isodow(timestamp) AS dw, avg(y) AS m FROM b2_ctx WHERE y IS NOT NULL GROUP BY 1, 2),
am_res AS (SELECT c.id, quantile_cont(c.y - w.m, [0.1, 0.5, 0.9]) AS q
           FROM b2_ctx c JOIN am_wm w ON w.id = c.id AND w.dw = isodow(c.timestamp)
           WHERE c.y IS NOT NULL GROUP BY c.id),
am_grid AS (SELECT id, CAST(T + CAST(k AS INTEGER) AS DATE) AS timestamp FROM am_last, range(1, 8) r(k))""") + f"""
SELECT g.id, g.timestamp, 'y' AS target_name, {_q('w.m', 'r.q', 6)}
FROM am_grid g LEFT JOIN am_wm w ON w.id = g.id AND w.dw = isodow(g.timestamp)
LEFT JOIN am_res r ON r.id = g.id"""

# --------------------------------------------------------------- B3 queries

SPLITS = """
tagged AS (
  SELECT *, 'context' AS split FROM b3 WHERE timestamp BETWEEN DATE '1995-01-01' AND DATE '1999-12-31'
  UNION ALL SELECT *, 'validation' FROM b3 WHERE timestamp BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'
  UNION ALL SELECT *, 'test' FROM b3 WHERE timestamp BETWEEN DATE '2001-01-01' AND DATE '2001-12-31'
  UNION ALL SELECT *, 'all' FROM b3 WHERE timestamp BETWEEN DATE '1995-01-01' AND DATE '2001-12-31')"""

PANEL_SPLITS = _with(B3, SPLITS) + "\nSELECT id, timestamp, y, split FROM tagged"

PANEL_SPLITS_PER_KEY = _with(B3, """
span AS (SELECT id, min(timestamp) AS lo, max(timestamp) AS hi FROM b3 WHERE y IS NOT NULL GROUP BY id),
cuts AS (SELECT id, lo, hi,
                CAST(lo + CAST(floor((hi - lo) * 0.7) AS INTEGER) AS DATE) AS c_end,
                CAST(lo + CAST(floor((hi - lo) * 0.85) AS INTEGER) AS DATE) AS v_end FROM span),
wins AS (
  SELECT id, 'context' AS split, lo AS s, c_end AS e FROM cuts
  UNION ALL SELECT id, 'validation', CAST(c_end + 1 AS DATE), v_end FROM cuts
  UNION ALL SELECT id, 'test', CAST(v_end + 1 AS DATE), hi FROM cuts)""") + """
SELECT b.id, b.timestamp, b.y, w.split FROM b3 b JOIN wins w ON b.id = w.id AND b.timestamp BETWEEN w.s AND w.e"""

SPLIT_COUNTS = _with(B3, SPLITS) + """
SELECT split, count(*) AS n_rows, count(DISTINCT id) AS n_ids, min(timestamp) AS min_ts,
       max(timestamp) AS max_ts, count(y) AS n_valued, round(sum(y), 2) AS sum_y
FROM tagged GROUP BY split"""

ORDERED_EXPORT = _with(B3) + """
SELECT id, timestamp, y, row_number() OVER (ORDER BY timestamp, id) - 1 AS position FROM b3"""

PROFILE = _with(B3) + """
SELECT count(*) AS n_rows, count(DISTINCT id) AS n_ids, min(timestamp) AS min_ts, max(timestamp) AS max_ts,
       count(*) FILTER (WHERE y IS NULL) AS n_null_value
FROM b3"""

B3_BASE = """
u_last AS (SELECT id, max(timestamp) AS T FROM b3_ctx GROUP BY id),
u_v AS (SELECT id, timestamp, y, CAST(timestamp - DATE '1970-01-01' AS DOUBLE) AS x FROM b3_ctx WHERE y IS NOT NULL),
u_steps AS (SELECT l.id, CAST(l.T + CAST(r.k AS INTEGER) AS DATE) AS timestamp FROM u_last l, range(1, 31) r(k))"""

FC_NAIVE = _with(B3, B3_BASE, """
fit AS (SELECT id, arg_max(y, timestamp) AS p FROM u_v GROUP BY id),
res AS (SELECT id, quantile_cont(y - py, [0.1, 0.5, 0.9]) AS q FROM (
          SELECT id, y, lag(y) OVER (PARTITION BY id ORDER BY timestamp) AS py FROM u_v) GROUP BY id)""") + f"""
SELECT s.id, s.timestamp, 'y' AS target_name, {_q('f.p', 'r.q')}
FROM u_steps s JOIN fit f USING (id) JOIN res r USING (id)"""

FC_MEAN = _with(B3, B3_BASE, """
fit AS (SELECT id, avg(y) AS p FROM u_v GROUP BY id),
res AS (SELECT v.id, quantile_cont(v.y - f.p, [0.1, 0.5, 0.9]) AS q FROM u_v v JOIN fit f USING (id) GROUP BY v.id)""") + f"""
SELECT s.id, s.timestamp, 'y' AS target_name, {_q('f.p', 'r.q')}
FROM u_steps s JOIN fit f USING (id) JOIN res r USING (id)"""

FC_DRIFT = _with(B3, B3_BASE, """
ends AS (SELECT id, arg_min(y, x) AS fy, min(x) AS fx, arg_max(y, x) AS ly, max(x) AS lx FROM u_v GROUP BY id),
fit AS (SELECT id, ly, lx, (ly - fy) / nullif(lx - fx, 0) AS b FROM ends),
res AS (SELECT d.id, quantile_cont((d.y - d.py) - f.b * (d.x - d.px), [0.1, 0.5, 0.9]) AS q FROM (
          SELECT id, y, x, lag(y) OVER w AS py, lag(x) OVER w AS px FROM u_v
          WINDOW w AS (PARTITION BY id ORDER BY timestamp)) d JOIN fit f USING (id) GROUP BY d.id)""") + f"""
SELECT s.id, s.timestamp, 'y' AS target_name,
       {_q("f.ly + f.b * (CAST(s.timestamp - DATE '1970-01-01' AS DOUBLE) - f.lx)", 'r.q')}
FROM u_steps s JOIN fit f USING (id) JOIN res r USING (id)"""

FC_TREND = _with(B3, B3_BASE, """
fit AS (SELECT id, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM u_v GROUP BY id),
res AS (SELECT v.id, quantile_cont(v.y - (f.a + f.b * v.x), [0.1, 0.5, 0.9]) AS q
        FROM u_v v JOIN fit f USING (id) GROUP BY v.id)""") + f"""
SELECT s.id, s.timestamp, 'y' AS target_name,
       {_q("f.a + f.b * CAST(s.timestamp - DATE '1970-01-01' AS DOUBLE)", 'r.q')}
FROM u_steps s JOIN fit f USING (id) JOIN res r USING (id)"""

RIDGE_COLUMNS = 12


def _solve(source: str, m: int) -> str:
    """CTEs e1..em, back: the symmetric system a1_1.., b1.. of one row in ``source``, by elimination without pivots."""
    out, src = [], source
    cols = lambda f: ", ".join(f(i, j) for i in range(1, m + 1) for j in [*range(1, m + 1), 0])
    name = lambda i, j: f"a{i}_{j}"
    for p in range(1, m):
        out.append(f"e{p} AS MATERIALIZED (SELECT " + cols(lambda i, j: name(i, j) if i <= p else (
            f"0.0 AS {name(i, j)}" if 0 < j <= p else
            f"{name(i, j)} - {name(i, p)} / {name(p, p)} * {name(p, j)} AS {name(i, j)}")) + f" FROM {src})")  # noqa: B023
        src = f"e{p}"
    for i in range(m, 0, -1):
        rest = "".join(f" - {name(i, j)} * x{j}" for j in range(i + 1, m + 1))
        out.append(f"s{i} AS MATERIALIZED (SELECT *, ({name(i, 0)}{rest}) / {name(i, i)} AS x{i} FROM {src})")
        src = f"s{i}"
    return ",\n".join(out)


_RIDGE_BASE = [
    B1, B1_LABEL, B1_FIRST,
    "rc AS (" + "\nUNION ALL ".join(
        f"SELECT f.day AS t, CAST(f.permco AS VARCHAR) || '_' || l.label || '_{x}' AS col, f.{x} AS v FROM b1_first f JOIN b1_label l USING (permco) "
        f"WHERE f.{x} IS NOT NULL" for x in FIELDS) + ")",
    "rn AS (SELECT '1_' || label || '_dlyvol' AS col FROM b1_label WHERE permco = 1)",
    "rg AS (SELECT CAST(unnest(generate_series(min(t), max(t), INTERVAL 1 DAY)) AS DATE) AS t FROM rc)",
    "ry AS (SELECT g.t, c.v AS y FROM rg g LEFT JOIN (SELECT t, v FROM rc WHERE col = (SELECT col FROM rn)) c USING (t))",
    "rctx AS (SELECT * FROM ry WHERE t BETWEEN DATE '1995-01-01' AND DATE '1999-12-31')",
    "rval AS (SELECT * FROM ry WHERE t BETWEEN DATE '2000-01-01' AND DATE '2000-12-31')",
    "rm AS (SELECT avg(y) AS my, count(y) AS ny FROM rctx)",
    "rx AS (SELECT * FROM rc WHERE col <> (SELECT col FROM rn))",
    "rb AS (SELECT x.*, y.y - m.my AS yc FROM rx x JOIN rctx y USING (t) CROSS JOIN rm m)",
    """rs AS (SELECT col, avg(v) AS mu, stddev_pop(v) AS sd FROM rb GROUP BY col HAVING stddev_pop(v) > 0),
rz AS (SELECT b.t, b.col, (b.v - s.mu) / s.sd AS z, b.yc FROM rb b JOIN rs s USING (col))"""]

_RIDGE_ALL = """rp AS (SELECT y.t, y.y, m.my + coalesce(f.add, 0) AS p FROM ry y CROSS JOIN rm m LEFT JOIN rfit f USING (t)),
rq AS (SELECT quantile_cont(p.y - p.p, [0.1, 0.5, 0.9]) AS q FROM rp p JOIN rctx USING (t)),
rfut AS (SELECT t FROM rval ORDER BY t LIMIT 120),
rmq AS (SELECT quantile_cont(y - my, [0.1, 0.5, 0.9]) AS q FROM rctx, rm),
rall AS (SELECT '1' AS id, t AS timestamp, 'y' AS target_name, p, q, 'with_covariates' AS model FROM rp JOIN rfut USING (t), rq
         UNION ALL
         SELECT '1', CAST(T + CAST(k AS INTEGER) AS DATE), 'y', my, q, 'no_covariates'
         FROM (SELECT max(t) AS T FROM rctx), range(1, 121) r(k), rm, rmq)"""

_RIDGE = _with(
    *_RIDGE_BASE,
    """rr AS (SELECT col, sum(z * yc) AS c FROM rz WHERE yc IS NOT NULL GROUP BY col),
rk AS (SELECT col, c, row_number() OVER (ORDER BY abs(c) DESC, col) AS r FROM rr QUALIFY r <= """ + str(RIDGE_COLUMNS) + """),
rzk AS (SELECT z.t, k.r, z.z FROM rz z JOIN rk k USING (col) WHERE z.yc IS NOT NULL),
rgm AS (SELECT p.r AS i, q.r AS j, sum(p.z * q.z) AS g FROM rzk p JOIN rzk q USING (t) GROUP BY 1, 2)""",
    "rsys AS MATERIALIZED (SELECT " + ", ".join(
        (f"coalesce((SELECT g FROM rgm WHERE i = {i} AND j = {j}), 0)" + (" + 0.1 * (SELECT ny FROM rm)" if i == j else "") if j else
         f"(SELECT c FROM rk WHERE r = {i})") + f" AS a{i}_{j}" for i in range(1, RIDGE_COLUMNS + 1) for j in [*range(1, RIDGE_COLUMNS + 1), 0]) + ")",
    _solve("rsys", RIDGE_COLUMNS),
    "rbeta AS (" + "\nUNION ALL ".join(f"SELECT {i} AS r, x{i} AS b FROM s1" for i in range(1, RIDGE_COLUMNS + 1)) + ")",
    """rfit AS (SELECT x.t, sum(b.b * (x.v - s.mu) / s.sd) AS add FROM rx x JOIN rk k USING (col) JOIN rbeta b USING (r) JOIN rs s USING (col) GROUP BY x.t),
""" + _RIDGE_ALL)

# All columns: (ZZ' + 0.1 n I) w = y - mean y over the valued days, reduced day by day, and b = Z'w.
_RIDGE_WHOLE = _with(
    *_RIDGE_BASE,
    """rd AS MATERIALIZED (SELECT t, y - my AS yc, row_number() OVER (ORDER BY t) AS i FROM rctx, rm WHERE y IS NOT NULL),
rzd AS MATERIALIZED (SELECT d.i, z.col, z.z FROM rz z JOIN rd d USING (t)),
rgm AS (SELECT p.i, q.i AS j, sum(p.z * q.z) AS g FROM rzd p JOIN rzd q USING (col) GROUP BY 1, 2),
rsys AS MATERIALIZED (
  SELECT p.i, list(coalesce(g.g, 0) + CASE WHEN p.i = q.i THEN 0.1 * m.ny ELSE 0 END ORDER BY q.i) || [any_value(p.yc)] AS a
  FROM rd p CROSS JOIN rd q CROSS JOIN rm m LEFT JOIN rgm g ON g.i = p.i AND g.j = q.i GROUP BY p.i),
re AS (
  SELECT CAST(0 AS BIGINT) AS k, i, a FROM rsys
  UNION ALL
  SELECT r.k + 1, r.i, CASE WHEN r.i = p.i THEN list_transform(r.a[2:], lambda x: x / r.a[1])
                            ELSE list_transform(list_zip(r.a[2:], p.a[2:]), lambda x: x[1] - x[2] * (r.a[1] / p.a[1])) END
  FROM re r JOIN re p ON p.i = p.k + 1),
rw AS MATERIALIZED (SELECT i, a[1] AS w FROM re WHERE len(a) = 1),
rbeta AS (SELECT col, sum(z.z * w.w) AS b FROM rzd z JOIN rw w USING (i) GROUP BY col),
rfit AS (SELECT x.t, sum(b.b * (x.v - s.mu) / s.sd) AS add FROM rx x JOIN rbeta b USING (col) JOIN rs s USING (col) GROUP BY x.t),
""" + _RIDGE_ALL).replace("WITH", "WITH RECURSIVE", 1)

FC_PANEL_COVARIATES = _RIDGE + f"\nSELECT id, timestamp, target_name, {_q('p')}, model FROM rall"

SCORE_PANEL_COVARIATES = _RIDGE_WHOLE + """,
rj AS (SELECT a.model, a.p, v.y FROM rall a JOIN rval v ON v.t = a.timestamp)
SELECT model, count(*) AS n, count(y) AS n_valid, """ + _r("avg((y - p) * (y - p))", 6) + " AS MSE, " + _r("avg(abs(y - p))", 6) + " AS MAE, " \
    + _r("sqrt(avg((y - p) * (y - p)))", 6) + " AS RMSE, " + _r("avg(abs((y - p) / nullif(y, 0))) * 100", 6) + " AS MAPE, " \
    + _r("1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(y), 0)", 6) + """ AS R2
FROM rj GROUP BY model"""

MACRO_ASOF = _with(B3, """
m AS (SELECT date_trunc('month', CAST(o_orderdate AS DATE)) AS mon, round(sum(o_totalprice), 2) AS v
      FROM orders GROUP BY 1),
av AS (SELECT CAST(mon + INTERVAL 1 MONTH AS DATE) AS avail, v FROM m)""") + """
SELECT d.id, d.timestamp, d.y, a.v AS macro_value
FROM b3 d ASOF LEFT JOIN av a ON d.timestamp >= a.avail"""

MACRO_MIXED = _with(B3, """
md AS (SELECT id, y, timestamp AS d FROM b3_obs),
mo AS (
  SELECT id, 'weekly' AS frequency, y, CAST(d + CAST((12 - isodow(d)) % 7 AS INTEGER) AS DATE) AS e, 5 AS lag FROM md
  UNION ALL SELECT id, 'monthly', y, last_day(d), 15 FROM md
  UNION ALL SELECT id, 'quarterly', y, CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE), 30 FROM md),
mv AS (SELECT id, frequency, CAST(e + lag AS DATE) AS avail, round(sum(y), 2) AS v FROM mo GROUP BY id, frequency, e, lag),
ml AS (SELECT b.*, f.frequency FROM b3 b, (VALUES ('weekly'), ('monthly'), ('quarterly')) f(frequency))""") + """
SELECT l.id, l.timestamp, l.y, l.frequency, a.v AS value
FROM ml l ASOF LEFT JOIN mv a ON l.id = a.id AND l.frequency = a.frequency AND l.timestamp >= a.avail"""

REGISTRY_LOAD = """
SELECT o.o_orderkey, o.o_custkey, CAST(o.o_orderdate AS DATE) AS o_orderdate, o.o_totalprice,
       o.o_orderstatus, o.o_orderpriority, c.c_nationkey, c.c_mktsegment, n.n_name
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE CAST(o.o_orderdate AS DATE) BETWEEN DATE '1992-01-01' AND DATE '2024-12-31'
  AND o.o_orderpriority IN ('1-URGENT', '2-HIGH')"""


# ------------------------------------------------------------------ calendars
#
# Per-year construction: each holiday's date is built for every year of the
# span (n-th weekday from the first of the month, last weekday back from the
# month end, Easter from a table of known dates), then observed shifts are
# applied, then dates are grouped.  Independent of the per-day predicates.


def _easter_values(first: int = 1900, last: int = 2100) -> str:
    from dateutil.easter import easter
    return ", ".join(f"({y}, DATE '{easter(y).isoformat()}')" for y in range(first, last + 1))


def _nth(m: int, w: int, n: int) -> str:
    f = f"make_date(y, {m}, 1)"
    return f"CAST({f} + CAST(((({w} - isodow({f})) + 7) % 7 + {7 * (n - 1)}) AS INTEGER) AS DATE)"


def _last(m: int, w: int) -> str:
    e = f"last_day(make_date(y, {m}, 1))"
    return f"CAST({e} - CAST(((isodow({e}) - {w}) + 7) % 7 AS INTEGER) AS DATE)"


def _fixed(m: int, d: int) -> str:
    return f"make_date(y, {m}, {d})"


# (calendar, order, name, date expression, first year, last year, observed, weekend kept, every)
_US = "publicHolidaysUS"
_UN = "unofficialHolidaysUS"
_NY = "financialHolidaysNYSE"
_EVENTS = [
    (_US, 1, "New Year's Day", _fixed(1, 1), 1, 9999, "both", True, 1),
    (_US, 2, "Martin Luther King Jr. Day", _nth(1, 1, 3), 1986, 9999, "none", True, 1),
    (_US, 3, "Washington's Birthday", _nth(2, 1, 3), 1971, 9999, "none", True, 1),
    (_US, 4, "Memorial Day", _last(5, 1), 1971, 9999, "none", True, 1),
    (_US, 5, "Juneteenth National Independence Day", _fixed(6, 19), 2021, 9999, "both", True, 1),
    (_US, 6, "Independence Day", _fixed(7, 4), 1, 9999, "both", True, 1),
    (_US, 7, "Labor Day", _nth(9, 1, 1), 1, 9999, "none", True, 1),
    (_US, 8, "Columbus Day", _nth(10, 1, 2), 1971, 9999, "none", True, 1),
    (_US, 9, "Veterans Day", _nth(10, 1, 4), 1971, 1977, "none", True, 1),
    (_US, 10, "Veterans Day", _fixed(11, 11), 1978, 9999, "both", True, 1),
    (_US, 11, "Thanksgiving Day", _nth(11, 4, 4), 1942, 9999, "none", True, 1),
    (_US, 12, "Christmas Day", _fixed(12, 25), 1, 9999, "both", True, 1),
    (_UN, 1, "Groundhog Day", _fixed(2, 2), 1, 9999, "none", True, 1),
    (_UN, 2, "Valentine's Day", _fixed(2, 14), 1, 9999, "none", True, 1),
    (_UN, 3, "Saint Patrick's Day", _fixed(3, 17), 1, 9999, "none", True, 1),
    (_UN, 4, "Halloween", _fixed(10, 31), 1, 9999, "none", True, 1),
    (_UN, 5, "Election Day", f"CAST({_nth(11, 1, 1)} + 1 AS DATE)", 1, 9999, "none", True, 4),
    (_NY, 1, "New Year's Day", _fixed(1, 1), 1, 9999, "sun_only", False, 1),
    (_NY, 2, "Martin Luther King Jr. Day", _nth(1, 1, 3), 1998, 9999, "none", True, 1),
    (_NY, 3, "Washington's Birthday", _nth(2, 1, 3), 1971, 9999, "none", True, 1),
    (_NY, 4, "Good Friday", "CAST(e.easter - 2 AS DATE)", 1, 9999, "none", True, 1),
    (_NY, 5, "Memorial Day", _last(5, 1), 1971, 9999, "none", True, 1),
    (_NY, 6, "Juneteenth National Independence Day", _fixed(6, 19), 2022, 9999, "both", False, 1),
    (_NY, 7, "Independence Day", _fixed(7, 4), 1, 9999, "both", False, 1),
    (_NY, 8, "Labor Day", _nth(9, 1, 1), 1, 9999, "none", True, 1),
    (_NY, 9, "Thanksgiving Day", _nth(11, 4, 4), 1942, 9999, "none", True, 1),
    (_NY, 10, "Christmas Day", _fixed(12, 25), 1, 9999, "both", False, 1),
]
_SPECIAL = [  # (order, name, date)
    (11, "Closed for Hurricane Gloria", "1985-09-27"),
    (12, "Day of Mourning for President Richard Nixon", "1994-04-27"),
    (13, "Closed for September 11 attacks", "2001-09-11"),
    (14, "Closed for September 11 attacks", "2001-09-12"),
    (15, "Closed for September 11 attacks", "2001-09-13"),
    (16, "Closed for September 11 attacks", "2001-09-14"),
    (17, "Day of Mourning for President Ronald Reagan", "2004-06-11"),
    (18, "Day of Mourning for President Gerald Ford", "2007-01-02"),
    (19, "Closed for Hurricane Sandy", "2012-10-29"),
    (20, "Closed for Hurricane Sandy", "2012-10-30"),
    (21, "Day of Mourning for President George H.W. Bush", "2018-12-05"),
    (22, "Day of Mourning for President Jimmy Carter", "2025-01-09"),
]


def _sq(s: str) -> str:
    return s.replace("'", "''")


def _holiday_sql(select: str) -> str:
    rows = []
    for cal, order, name, expr, fy, ly, obs, kept, every in _EVENTS:
        base = (f"SELECT '{cal}' AS cal, {order} AS ord, '{_sq(name)}' AS name, {expr} AS d, "
                f"'{obs}' AS obs, {str(kept).upper()} AS kept FROM yrs JOIN easter_t e USING (y) "
                f"WHERE y BETWEEN {fy} AND {ly} AND y % {every} = 0")
        rows.append(base)
    actual = "\n  UNION ALL ".join(rows)
    special = ", ".join(f"('{_NY}', {o}, '{_sq(n)}', DATE '{d}')" for o, n, d in _SPECIAL)
    return f"""
WITH span AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
yrs AS (SELECT CAST(unnest(range(year(lo) - 1, year(hi) + 2)) AS INTEGER) AS y FROM span),
easter_t AS (SELECT * FROM (VALUES {_easter_values()}) v(y, easter)),
actual AS (
  {actual}),
events AS (
  SELECT cal, ord, name, d FROM actual WHERE kept OR isodow(d) <= 5
  UNION ALL SELECT cal, ord, name || ' (observed)', CAST(d - 1 AS DATE) FROM actual
            WHERE obs = 'both' AND isodow(d) = 6
  UNION ALL SELECT cal, ord, name || ' (observed)', CAST(d + 1 AS DATE) FROM actual
            WHERE obs IN ('both', 'sun_only') AND isodow(d) = 7
  UNION ALL SELECT * FROM (VALUES {special}) s(cal, ord, name, d)),
inspan AS (SELECT e.* FROM events e, span WHERE e.d BETWEEN span.lo AND span.hi),
named AS (SELECT d, cal, string_agg(name, '; ' ORDER BY ord) AS names FROM inspan GROUP BY d, cal),
cal AS (
  SELECT d AS timestamp,
         max(names) FILTER (WHERE cal = '{_US}') AS publicHolidaysUS,
         max(names) FILTER (WHERE cal = '{_UN}') AS unofficialHolidaysUS,
         max(names) FILTER (WHERE cal = '{_NY}') AS financialHolidaysNYSE
  FROM named GROUP BY d)
{select}"""


HOLIDAY_CALENDAR = _holiday_sql("SELECT * FROM cal")
HOLIDAY_US = _holiday_sql("SELECT timestamp, publicHolidaysUS, unofficialHolidaysUS FROM cal")
HOLIDAY_NYSE = _holiday_sql("SELECT timestamp, financialHolidaysNYSE FROM cal")


def _holiday_flags() -> str:
    sql = _holiday_sql("")
    body = sql.replace("\nWITH ", "", 1)
    return (_with(B3) + ",\n" + body.rstrip() + """
SELECT b.id, b.timestamp, b.y, c.publicHolidaysUS IS NOT NULL AS is_us_public,
       c.financialHolidaysNYSE IS NOT NULL AS is_nyse_closed, c.publicHolidaysUS AS holiday
FROM b3 b LEFT JOIN cal c USING (timestamp)""")


HOLIDAY_FLAGS = _holiday_flags()


def _holiday_ctes() -> str:
    return _holiday_sql("").replace("\nWITH ", "", 1).rstrip()


HOLIDAY_CLOSURES = _with(B3) + ",\n" + _holiday_ctes().replace("named AS (", """own AS (
  SELECT '""" + _NY + """' AS cal, 1000000 AS ord, 'No orders: ' || n.n_name AS name, b.timestamp AS d
  FROM b3 b JOIN nation n ON n.n_nationkey = b.id WHERE b.y IS NULL AND n.n_regionkey = 0),
named AS (""").replace("string_agg(name, '; ' ORDER BY ord) AS names FROM inspan", "string_agg(name, '; ' ORDER BY ord, name) AS names FROM (SELECT * FROM inspan UNION ALL SELECT * FROM own)") + "\nSELECT * FROM cal"

FC_HOLIDAY_COVARIATES = _with(B3) + ",\n" + _holiday_ctes() + """,
hb AS (SELECT b.id, b.timestamp, b.y, CAST(c.publicHolidaysUS IS NOT NULL AS DOUBLE) AS x, CAST(c.financialHolidaysNYSE IS NOT NULL AS DOUBLE) AS z
       FROM b3 b LEFT JOIN cal c USING (timestamp)),
hc AS (SELECT * FROM hb WHERE timestamp BETWEEN DATE '1995-01-01' AND DATE '1999-12-31' AND y IS NOT NULL),
h1 AS (SELECT id, regr_slope(z, x) AS zx, regr_intercept(z, x) AS zi, regr_slope(y, x) AS yx, regr_intercept(y, x) AS yi,
              var_pop(x) AS vx, var_pop(z) AS vz FROM hc GROUP BY id),
h2 AS (SELECT c.id, regr_slope(c.y - (s.yi + s.yx * c.x), c.z - (s.zi + s.zx * c.x)) AS b1,
              var_pop(c.z - (s.zi + s.zx * c.x)) AS vr FROM hc c JOIN h1 s USING (id) GROUP BY c.id),
hp AS (SELECT id, yx - b1 * zx AS b0, b1, yi - b1 * zi AS a FROM h1 JOIN h2 USING (id) WHERE vx > 0 AND vr > 1e-10 * vz),
hq AS (SELECT c.id, quantile_cont(c.y - (p.a + p.b0 * c.x + p.b1 * c.z), [0.1, 0.5, 0.9]) AS q FROM hc c JOIN hp p USING (id) GROUP BY c.id),
hf AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY timestamp) AS rn FROM hb WHERE timestamp BETWEEN DATE '2000-01-01' AND DATE '2000-12-31')
SELECT f.id, f.timestamp, 'y' AS target_name, """ + _q("p.a + p.b0 * f.x + p.b1 * f.z", "q.q") + """
FROM hf f LEFT JOIN hp p USING (id) LEFT JOIN hq q USING (id) WHERE f.rn <= 30"""

FC_HOURLY = _with("""
eo AS (SELECT event_type AS id, date_trunc('hour', ts) AS t, round(sum(value), 6) AS y FROM events
       WHERE event_type IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2),
es AS (SELECT min(t) AS lo, max(t) AS hi FROM eo WHERE y IS NOT NULL),
eg AS (SELECT i.id, unnest(generate_series(s.lo, s.hi, INTERVAL 1 HOUR)) AS t FROM (SELECT DISTINCT id FROM eo) i, es s),
ec AS (SELECT g.id, g.t, o.y FROM eg g LEFT JOIN eo o USING (id, t) WHERE g.t < TIMESTAMP '2024-01-24'),
er AS (SELECT id, quantile_cont(y - ly, [0.1, 0.5, 0.9]) AS q FROM (SELECT id, y, lag(y, 24) OVER (PARTITION BY id ORDER BY t) AS ly FROM ec) GROUP BY id),
el AS (SELECT id, max(t) AS T FROM ec GROUP BY id)""") + f"""
SELECT l.id, l.T + to_hours(k) AS timestamp, 'y' AS target_name, {_q('c.y', 'r.q')}
FROM el l CROSS JOIN range(1, 25) s(k) LEFT JOIN ec c ON c.id = l.id AND c.t = l.T + to_hours(k - 24) LEFT JOIN er r ON r.id = l.id"""

FC_WEEKLY = _with(B3, """
wo AS (SELECT id, CAST(date_trunc('week', timestamp) AS DATE) AS w, round(sum(y), 2) AS y FROM b3_obs GROUP BY 1, 2),
wv AS (SELECT id, w, y, CAST(w - DATE '1970-01-01' AS DOUBLE) / 7 AS x FROM wo WHERE w BETWEEN DATE '1995-01-01' AND DATE '1999-12-31' AND y IS NOT NULL),
ws AS (SELECT max(w) AS T FROM (SELECT CAST(unnest(generate_series(min(w), max(w), INTERVAL 7 DAY)) AS DATE) AS w FROM wo)
       WHERE w BETWEEN DATE '1995-01-01' AND DATE '1999-12-31'),
we AS (SELECT id, arg_min(y, x) AS fy, min(x) AS fx, arg_max(y, x) AS ly, max(x) AS lx FROM wv GROUP BY id),
wf AS (SELECT id, ly, lx, (ly - fy) / nullif(lx - fx, 0) AS b FROM we),
wr AS (SELECT d.id, quantile_cont((d.y - d.py) - f.b * (d.x - d.px), [0.1, 0.5, 0.9]) AS q FROM (
         SELECT id, y, x, lag(y) OVER w AS py, lag(x) OVER w AS px FROM wv WINDOW w AS (PARTITION BY id ORDER BY x)) d JOIN wf f USING (id) GROUP BY d.id)""") + f"""
SELECT f.id, CAST(s.T + CAST(7 * k AS INTEGER) AS DATE) AS timestamp, 'y' AS target_name,
       {_q("f.ly + f.b * (CAST(s.T - DATE '1970-01-01' AS DOUBLE) / 7 + k - f.lx)", 'r.q')}
FROM wf f JOIN wr r USING (id) CROSS JOIN ws s CROSS JOIN range(1, 14) g(k)"""

ORACLE: dict[str, str] = {
    "entity_keys": ENTITY_KEYS,
    "last_label": LAST_LABEL,
    "first_valid_long": FIRST_VALID_LONG,
    "panel_dense_long": PANEL_DENSE_LONG,
    "panel_wide_selected": PANEL_WIDE_SELECTED,
    "panel_manifest": PANEL_MANIFEST,
    "panel_blocks": PANEL_BLOCKS,
    "dup_and_null_checks": DUP_AND_NULL_CHECKS,
    "csv_roundtrip": CSV_ROUNDTRIP,
    "panel_densified": PANEL_DENSIFIED,
    "panel_splits": PANEL_SPLITS,
    "panel_splits_per_key": PANEL_SPLITS_PER_KEY,
    "split_counts": SPLIT_COUNTS,
    "ordered_export": ORDERED_EXPORT,
    "profile": PROFILE,
    "fc_naive": FC_NAIVE,
    "fc_mean": FC_MEAN,
    "fc_drift": FC_DRIFT,
    "fc_trend": FC_TREND,
    "fc_seasonal_naive": FC_SEASONAL_NAIVE,
    "fc_covariate_ols": FC_COVARIATE_OLS,
    "fc_pooled_ols": FC_POOLED_OLS,
    "fc_past_covariates": FC_PAST_COVARIATES,
    "fc_pooled_ar": FC_POOLED_AR,
    "fc_panel_covariates": FC_PANEL_COVARIATES,
    "score_panel_covariates": SCORE_PANEL_COVARIATES,
    "fc_combined": FC_COMBINED,
    "fc_apply_model": FC_APPLY_MODEL,
    "score_by_model": SCORE_BY_MODEL,
    "score_by_model_skip": SCORE_BY_MODEL_SKIP,
    "score_long": SCORE_LONG,
    "plot_frame": PLOT_FRAME,
    "plot_frame_one": PLOT_FRAME_ONE,
    "fc_apply_model_rows": FC_APPLY_MODEL,
    "fc_hourly": FC_HOURLY,
    "fc_weekly": FC_WEEKLY,
    "fc_holiday_covariates": FC_HOLIDAY_COVARIATES,
    "holiday_closures": HOLIDAY_CLOSURES,
    "holiday_calendar": HOLIDAY_CALENDAR,
    "holiday_us": HOLIDAY_US,
    "holiday_nyse": HOLIDAY_NYSE,
    "holiday_flags": HOLIDAY_FLAGS,
    "macro_asof": MACRO_ASOF,
    "macro_mixed": MACRO_MIXED,
    "registry_load": REGISTRY_LOAD,
}
