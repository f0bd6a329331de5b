"""DuckDB SQL of the additive seasonal model: recursion over the months, normal
equations as sums over (month, unknown, unknown), elimination by recursion over
the unknowns.  The parameter grid is the engine's (whole 1/10,000s)."""

from __future__ import annotations

from shelfmark import config
from shelfmark.operators.seasonal import GRID, PIVOT, SSE_DIGITS, STEPS, UNIT


def _round_sql(name: str, candidates: str, period: int) -> list[str]:
    """CTEs that try ``candidates`` (category, a, b, g): <name>_m holds the
    reduced normal matrix, <name> the best parameters of each category."""
    u = period + 1                  # unknowns; element u + 1 is the constant
    every = f"range(1, {u + 2})"

    def unit(at):
        return "[" + ", ".join(f"CAST({int(i == at)} AS DOUBLE)" for i in range(u + 1)) + "]"

    ring = ", ".join(unit(1 + i if i else -1) for i in range(period))
    al, be, ga = (f"q.{p} / {UNIT}.0::DOUBLE" for p in "abg")
    return [
        f"{name}_c AS ({candidates})",
        f"""{name}_r AS (
  SELECT c.category, c.a, c.b, c.g, 0 AS t, {unit(0)} AS l, {unit(1)} AS d, [{ring}] AS s,
         CAST(NULL AS DOUBLE[]) AS e
  FROM {name}_c c
  UNION ALL
  SELECT q.category, q.a, q.b, q.g, q.t + 1,
         [q.l[j] + q.d[j] + {al} * q.e[j] for j in {every}],
         [q.d[j] + {al} * ({be}) * q.e[j] for j in {every}],
         list_append(q.s[2:], [q.s[1][j] + {ga} * (1 - {al}) * q.e[j] for j in {every}]),
         q.e
  FROM (SELECT r.category, r.a, r.b, r.g, r.t, r.l, r.d, r.s,
               [CASE WHEN j = {u + 1} THEN h.y[r.t + 1] ELSE 0 END - r.l[j] - r.d[j] - r.s[1][j] for j in {every}] AS e
        FROM {name}_r r JOIN hs h ON r.category = h.category WHERE r.t < h.n) q)""",
        f"""{name}_n AS (
  SELECT category, a, b, g, i, LIST(v ORDER BY j) AS v FROM (
    SELECT r.category, r.a, r.b, r.g, x.i, z.j, SUM(r.e[x.i] * r.e[z.j]) AS v
    FROM {name}_r r, {every} x(i), {every} z(j) WHERE r.t > 0 GROUP BY ALL)
  GROUP BY ALL)""",
        f"""{name}_m AS (
  SELECT category, a, b, g, 1 AS k, LIST(v ORDER BY i) AS m FROM {name}_n GROUP BY category, a, b, g
  UNION ALL
  SELECT category, a, b, g, k + 1,
         [CASE WHEN m[k][k] <= {PIVOT} THEN [CASE WHEN i = k THEN 0 ELSE m[i][j] END for j in {every}]
               WHEN i = k THEN [m[k][j] / m[k][k] for j in {every}]
               ELSE [m[i][j] - m[i][k] * m[k][j] / m[k][k] for j in {every}] END for i in {every}]
  FROM {name}_m WHERE k <= {u})""",
        f"""{name} AS (
  SELECT category, a, b, g, m FROM (
    SELECT category, a, b, g, m, ROW_NUMBER() OVER (
      PARTITION BY category ORDER BY ROUND(GREATEST(0, m[{u + 1}][{u + 1}]), {SSE_DIGITS}), a, b, g) AS rn
    FROM {name}_m WHERE k = {u + 1}) WHERE rn = 1)"""]


def _near(name: str, param: str, step: int) -> str:
    return f"""(SELECT DISTINCT category, GREATEST(0, LEAST({UNIT}, {param} + o * {step})) AS {param}
     FROM {name}, range(-2, 3) f(o))"""


def seasonal_ctes(src: str, period: int = config.SEASONAL_PERIOD, horizon: int = config.FORECAST_MONTHS) -> list[str]:
    """CTEs ending in ``hw`` (category, h, month, forecast, confidence_lower,
    confidence_upper, alpha, beta, gamma) over ``src`` (category, month,
    quantity); needs WITH RECURSIVE."""
    grid = ", ".join(f"({v})" for v in GRID)
    distinct = f"""SELECT DISTINCT category, a, CASE WHEN a = 0 THEN 0 ELSE b END AS b,
       CASE WHEN a = {UNIT} THEN 0 ELSE g END AS g"""
    ctes = [f"""hs AS (
  SELECT category, n, last_m, top, [v / top for v in vals] AS y FROM (
    SELECT category, COUNT(*) AS n, MAX(month) AS last_m, CAST(GREATEST(1, MAX(ABS(quantity))) AS DOUBLE) AS top,
           LIST(CAST(quantity AS DOUBLE) ORDER BY month) AS vals
    FROM {src} GROUP BY category) WHERE n >= {2 * period})""",
            *_round_sql("hw1", f"""{distinct}
    FROM hs, (VALUES {grid}) ga(a), (VALUES {grid}) gb(b), (VALUES {grid}) gg(g)""", period)]
    last = "hw1"
    for i, step in enumerate(STEPS, start=2):
        ctes += _round_sql(f"hw{i}", f"""{distinct}
    FROM {_near(last, "a", step)} JOIN {_near(last, "b", step)} USING (category)
    JOIN {_near(last, "g", step)} USING (category)""", period)
        last = f"hw{i}"
    z = repr(config.Z_95)
    ctes += [
        f"""hx AS (
  SELECT w.category, w.a / {UNIT}.0::DOUBLE AS a, w.b / {UNIT}.0::DOUBLE AS b, w.g / {UNIT}.0::DOUBLE AS g, h.n, h.y,
         [-w.m[i][{period + 2}] for i in range(1, {period + 2})] AS x
  FROM {last} w JOIN hs h ON w.category = h.category)""",
        f"""hrun AS (
  SELECT category, 0 AS t, x[1] AS l, x[2] AS d, list_prepend(CAST(0 AS DOUBLE), x[3:]) AS s, CAST(NULL AS DOUBLE) AS e
  FROM hx
  UNION ALL
  SELECT category, t + 1, l + d + a * e, d + a * b * e, list_append(s[2:], s[1] + g * (1 - a) * e), e
  FROM (SELECT r.category, r.t, r.l, r.d, r.s, x.a, x.b, x.g, x.y[r.t + 1] - r.l - r.d - r.s[1] AS e
        FROM hrun r JOIN hx x ON r.category = x.category WHERE r.t < x.n))""",
        f"""hp AS (
  SELECT h.category, CAST(f.i AS INTEGER) AS h, strftime(h.last_m + to_months(CAST(f.i AS INTEGER)), '%Y-%m') AS month,
         (r.l + f.i * r.d + r.s[(f.i - 1) % {period} + 1]) * h.top AS pred, dev.sd * h.top * CAST({z} AS DOUBLE) AS w,
         x.a AS alpha, x.b AS beta, x.g AS gamma
  FROM hs h JOIN hx x ON h.category = x.category JOIN hrun r ON r.category = h.category AND r.t = h.n
  JOIN (SELECT category, STDDEV_POP(e) AS sd FROM hrun WHERE t > 0 GROUP BY category) dev ON dev.category = h.category,
       range(1, {horizon + 1}) f(i))""",
        """hw AS (
  SELECT category, h, month, CAST(ROUND_EVEN(GREATEST(0, pred), 0) AS BIGINT) AS forecast,
         CAST(ROUND_EVEN(GREATEST(0, pred - w), 0) AS BIGINT) AS confidence_lower,
         CAST(ROUND_EVEN(pred + w, 0) AS BIGINT) AS confidence_upper, alpha, beta, gamma FROM hp)"""]
    return ctes
