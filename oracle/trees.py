"""The first boosted trees, split by split: counts per candidate cut, gains, best cut, next nodes."""

from __future__ import annotations

from oracle.common import CONTINUOUS, COUNTRY_COLUMNS, SPL, r

COLUMNS = [*CONTINUOUS, "is_single_order_customer", *COUNTRY_COLUMNS]
_NAMES = "[" + ", ".join(f"'{c}'" for c in COLUMNS) + "]"
_VALUES = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in COLUMNS) + "]"

# Cuts are the nearest-rank quantiles at i / 64; gradients are whole multiples of 2^-30.
BASE = f"""
share AS (SELECT CAST(sum(y) AS DOUBLE) / count(*) AS p FROM train),
slopes AS MATERIALIZED (
  SELECT customer_id, CAST(round((p - y) * 1073741824) AS BIGINT) AS g,
         CAST(round(p * (1 - p) * 1073741824) AS BIGINT) AS h FROM train, share),
cells AS MATERIALIZED (
  SELECT customer_id, unnest(range(0, {len(COLUMNS)})) AS col, unnest({_VALUES}) AS value FROM train),
placed AS (
  SELECT col, value, row_number() OVER (PARTITION BY col ORDER BY value) AS place,
         count(*) OVER (PARTITION BY col) AS n FROM cells),
cuts AS MATERIALIZED (
  SELECT DISTINCT col, value AS cut FROM placed, unnest(range(1, 64)) AS q(i)
  WHERE place = greatest(1, CAST(ceil(i * n / 64.0) AS BIGINT))),
at0 AS MATERIALIZED (SELECT customer_id, CAST(1 AS BIGINT) AS node FROM train)"""


def _worth(g: str, h: str, l1: float, l2: float) -> str:
    kept = f"(sign({g}) * greatest(abs({g}) - {l1}, 0))"
    return f"({kept} * {kept} / ({h} + {l2}))"


def _step(k: int, due: str, l1: float, l2: float, min_rows: int, min_curvature: float,
          one: bool) -> str:
    """CTEs best{k}: the best cut of each due node (or of all), and at{k + 1}: where rows go then."""
    sums = ("CAST(sum(g) AS DOUBLE) / 1073741824 AS g{0}, CAST(sum(h) AS DOUBLE) / 1073741824 AS h{0}, "
            "count(*) AS n{0}")
    worths = [_worth(*x, l1, l2) for x in (("gl", "hl"), ("(ga - gl)", "(ha - hl)"), ("ga", "ha"))]
    first = "ORDER BY gain DESC, node, col, cut" if one else "PARTITION BY node ORDER BY gain DESC, col, cut"
    return f"""
whole{k} AS (SELECT node, {sums.format('a')} FROM at{k} JOIN slopes USING (customer_id) GROUP BY node),
left{k} AS (
  SELECT node, cells.col, cut, {sums.format('l')}
  FROM at{k} JOIN slopes USING (customer_id) JOIN cells USING (customer_id)
  JOIN cuts ON cuts.col = cells.col AND value <= cut WHERE {due} GROUP BY ALL),
gains{k} AS (
  SELECT *, {worths[0]} + {worths[1]} - {worths[2]} AS gain FROM left{k} JOIN whole{k} USING (node)
  WHERE nl >= {min_rows} AND na - nl >= {min_rows}
    AND hl >= {min_curvature} AND ha - hl >= {min_curvature}),
best{k} AS MATERIALIZED (
  SELECT node, col, cut, gain FROM gains{k} WHERE gain > 1e-9
  QUALIFY row_number() OVER ({first}) = 1),
at{k + 1} AS MATERIALIZED (
  SELECT at{k}.customer_id, CASE WHEN b.node IS NULL THEN at{k}.node
                                 WHEN value <= cut THEN 2 * at{k}.node ELSE 2 * at{k}.node + 1 END AS node
  FROM at{k} LEFT JOIN best{k} b USING (node)
  LEFT JOIN cells c ON c.customer_id = at{k}.customer_id AND c.col = b.col)"""


def first_tree(steps: int, by_leaf: bool, l1: float, l2: float, min_rows: int = 1,
               min_curvature: float = 0.0) -> str:
    """All nodes of a tree grown by ``steps`` levels, or by ``steps`` splits of the best leaf."""
    parts = [SPL, BASE]
    for k in range(steps):
        due = "TRUE" if by_leaf else f"node >= {1 << k}"
        parts.append(_step(k, due, l1, l2, min_rows, min_curvature, by_leaf))
    inner = " UNION ALL ".join(
        f"SELECT node, {_NAMES}[col + 1] AS feature, cut, gain, (SELECT count(*) FROM at{k} a WHERE "
        f"a.node = b.node) AS n FROM best{k} b" for k in range(steps))
    g, h = (f"(CAST(sum({c}) AS DOUBLE) / 1073741824)" for c in "gh")
    value = f"-0.1 * (sign({g}) * greatest(abs({g}) - {l1}, 0)) / ({h} + {l2})"
    return f"""{','.join(parts)}
SELECT node, feature, {r('cut', 'threshold')}, {r('gain', 'gain')}, CAST(NULL AS DOUBLE) AS value,
       CAST(n AS BIGINT) AS n_rows FROM ({inner})
UNION ALL
SELECT node, NULL, NULL, NULL, {r(value, 'value')}, count(*)
FROM at{steps} JOIN slopes USING (customer_id) GROUP BY node"""


SQL = {
    "d5_first_tree": first_tree(3, False, 0.5, 1.0, min_curvature=1.0),
    "d6_first_tree": first_tree(6, True, 0.5, 1.0, min_rows=20),
}
