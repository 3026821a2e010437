"""SQL that grows the same trees, level by level, over columns ``x`` (a list) and ``y`` of ``base``."""

from __future__ import annotations

_ALIKE = "1e-10"


def _start(base: str) -> str:
    return f"""base AS MATERIALIZED ({base}),
rws AS MATERIALIZED (SELECT row_number() OVER () AS id, x, y, avg(y) OVER () AS my FROM base),
lx AS MATERIALIZED (SELECT id, unnest(x) AS v, unnest(range(len(x))) AS f FROM rws)"""


def _pick(name: str, source: str, order: str) -> str:
    """The first in ``order`` of the rows with the best gain of their node."""
    return f"""{name} AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t, node ORDER BY {order}) AS rk FROM
  (SELECT *, max(gain) OVER (PARTITION BY t, node) AS top FROM {source}) WHERE gain >= top - {_ALIKE} * abs(top)) WHERE rk = 1)"""


def _descend(name: str, state: str, best: str) -> str:
    return f"""{name} AS MATERIALIZED (SELECT s.t, s.id, CASE WHEN b.f IS NULL THEN s.node ELSE 2 * s.node + (lx.v > b.cut)::INT END AS node
  FROM {state} s LEFT JOIN {best} b ON s.t = b.t AND s.node = b.node LEFT JOIN lx ON lx.id = s.id AND lx.f = b.f)"""


def extra_trees(base: str, trees: int, depth: int, seed: int = 42) -> str:
    """CTEs; the last one, ``pred``, has ``id``, ``y`` and ``prediction``."""
    out = [_start(base), f"s0 AS MATERIALIZED (SELECT t, id, 1::BIGINT AS node FROM rws, range({trees}) q(t))"]
    for d in range(depth):
        out.append(f"""r{d} AS MATERIALIZED (SELECT t, node, f, min(v) AS low, max(v) AS high, count(*) AS n, sum(y - my) AS s,
  sum((y - my) ** 2) AS ss FROM s{d} JOIN lx USING (id) JOIN rws USING (id) GROUP BY ALL),
c{d} AS MATERIALIZED (SELECT *, low + ('0x' || substr(md5('{seed}:' || t || ':' || node || ':' || f), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE
  * (high - low) AS cut FROM r{d} WHERE low < high AND n >= 2 AND ss - s * s / n > {_ALIKE} * ss),
g{d} AS MATERIALIZED (SELECT t, node, f, cut, sl * sl / nl + (s - sl) ** 2 / (n - nl) - s * s / n AS gain FROM (
  SELECT t, node, f, any_value(cut) AS cut, any_value(n) AS n, any_value(s) AS s, count(*) FILTER (v <= cut) AS nl,
    sum(y - my) FILTER (v <= cut) AS sl FROM s{d} JOIN lx USING (id) JOIN rws USING (id) JOIN c{d} USING (t, node, f) GROUP BY ALL)
  WHERE nl > 0 AND nl < n)""")
        out.append(_pick(f"b{d}", f"g{d}", "f"))
        out.append(_descend(f"s{d + 1}", f"s{d}", f"b{d}"))
    out.append(f"""leaf AS (SELECT t, node, avg(y - my) + any_value(my) AS value FROM s{depth} JOIN rws USING (id) GROUP BY ALL),
pred AS (SELECT id, any_value(y) AS y, avg(value) AS prediction FROM s{depth} JOIN leaf USING (t, node) JOIN rws USING (id) GROUP BY id)""")
    return ",\n".join(out)


def boosted(base: str, rounds: int, depth: int, rate: float, ridge: float) -> str:
    """CTEs; the last one, ``pred``, has ``id``, ``y`` and ``prediction``."""
    out = [_start(base), "m0 AS MATERIALIZED (SELECT id, my AS m, y FROM rws)"]
    for r in range(rounds):
        out.append(f"s{r}_0 AS MATERIALIZED (SELECT 0 AS t, id, 1::BIGINT AS node FROM rws)")
        for d in range(depth):
            at = f"{r}_{d}"
            out.append(f"""h{at} AS (SELECT t, node, f, v AS cut, sum(m - y) AS g, count(*) AS h
  FROM s{at} JOIN lx USING (id) JOIN m{r} USING (id) GROUP BY ALL),
a{at} AS (SELECT *, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY t, node, f) AS ga,
  sum(h) OVER (PARTITION BY t, node, f) AS ha FROM h{at} WINDOW w AS (PARTITION BY t, node, f ORDER BY cut)),
g{at} AS MATERIALIZED (SELECT *, gl ** 2 / (hl + {ridge}) + (ga - gl) ** 2 / (ha - hl + {ridge}) - ga ** 2 / (ha + {ridge}) AS gain
  FROM a{at} WHERE hl < ha)""")
            out.append(_pick(f"b{at}", f"(SELECT * FROM g{at} WHERE gain > {_ALIKE} * (gain + ga ** 2 / (ha + {ridge})))", "f, cut"))
            out.append(_descend(f"s{r}_{d + 1}", f"s{at}", f"b{at}"))
        last = f"s{r}_{depth}"
        out.append(f"""v{r} AS MATERIALIZED (SELECT node, -{rate} * sum(m - y) / (count(*) + {ridge}) AS value FROM {last} JOIN m{r} USING (id) GROUP BY node),
m{r + 1} AS MATERIALIZED (SELECT id, m + value AS m, y FROM m{r} JOIN {last} USING (id) JOIN v{r} USING (node))""")
    out.append(f"pred AS (SELECT id, y, m AS prediction FROM m{rounds})")
    return ",\n".join(out)
