"""Checking SQL for the model queries: closed forms of the linear fits, trees by trying all splits.

Every fit has a number ``k``: the fold it leaves out, or -1 for the one on all training rows.
``known`` are its rows, ``asked`` the rows it predicts.
"""

from __future__ import annotations

import hashlib

from checks import sql as S


def bucket(parts: int, *tail: str) -> str:
    key = ", ".join(["id", *(f"'{t}'" for t in tail)])
    return f"('0x' || substr(md5(concat_ws('|', {key})), 1, 8))::BIGINT % {parts}"


ROWS = f"""{S.WITH_SKILLS}, model_rows AS (
  SELECT id, role_category, CAST(len(description_clean) AS DOUBLE) AS description_length,
    CAST(len(skills) AS DOUBLE) AS n_skills_total, ln(pay) AS y,
    CASE WHEN {bucket(100, '', '42')} < 20 THEN -1 ELSE {bucket(5, '', '43')} END AS part
  FROM posts WHERE pay IS NOT NULL),
known AS (SELECT * FROM model_rows, (SELECT unnest(range(-1, 5)) AS k) WHERE part <> -1 AND part <> k),
asked AS (SELECT *, part AS k FROM model_rows)"""

# One label and one scaled number. For a given slope b, the effects of the labels and the
# intercept are linear in b, which leaves one equation for b.
LINEAR = f"""{ROWS},
scaling AS (SELECT k, avg(description_length) AS mx, stddev_samp(description_length) AS sx FROM known GROUP BY 1),
scaled AS (SELECT k, role_category AS g, y, (description_length - mx) / sx AS z FROM known JOIN scaling USING (k)),
per_label AS (SELECT k, g, count(*) AS n, sum(y) AS sy, sum(z) AS sz FROM scaled GROUP BY 1, 2),
per_fit AS (SELECT k, sum(z * z) AS szz, sum(z * y) AS szy FROM scaled GROUP BY 1),
penalties AS (SELECT 'linear_regression' AS model, 0.0 AS a UNION ALL SELECT 'ridge', 1.0),
starts AS (
  SELECT model, a, k, sum(sy / (n + a)) / sum(n / (n + a)) AS oy, sum(sz / (n + a)) / sum(n / (n + a)) AS oz
  FROM per_label, penalties GROUP BY 1, 2, 3),
effects AS (
  SELECT model, a, k, g, sz, oy, oz, (sy - n * oy) / (n + a) AS wy, (sz - n * oz) / (n + a) AS wz
  FROM per_label JOIN starts USING (k)),
slopes AS (
  SELECT model, k, (szy - sum((oy + wy) * sz)) / (szz - sum((oz + wz) * sz) + a) AS b
  FROM effects JOIN per_fit USING (k) GROUP BY model, k, a, szy, szz),
linear AS (
  SELECT s.model, t.k, t.id, t.y,
    o.oy + coalesce(e.wy, 0) - s.b * (o.oz + coalesce(e.wz, 0)) + s.b * (t.description_length - c.mx) / c.sx AS p
  FROM asked t JOIN scaling c USING (k) JOIN slopes s USING (k) JOIN starts o ON o.k = t.k AND o.model = s.model
  LEFT JOIN effects e ON e.k = t.k AND e.model = s.model AND e.g = t.role_category)"""


def _tree(number: int, depth: int, labels: list[str], numbers: list[str], rate: float) -> str:
    """From the rows ``t<number>`` (use, k, ..., p) to ``t<number + 1>``."""
    names = sorted([*labels, *numbers], key=lambda n: hashlib.md5(f"{n}|{number}".encode()).hexdigest())
    used = names[: max(1, int(0.8 * len(names)))]
    t = f"t{number}"
    text = f""",
{t}_0 AS (SELECT *, 1 AS node, 0.0 AS w, use = 'known' AND {bucket(100, str(number))} < 80 AS drawn FROM {t})"""
    for level in range(depth):
        rows = f"{t}_{level}"
        cells = " UNION ALL ".join(
            f"SELECT k, node, '{c}' AS c, {c + ' AS lab, 0.0 AS val' if c in labels else 'NULL AS lab, ' + c + ' AS val'}, p - y AS grad FROM {rows} WHERE drawn AND node >= {1 << level}"
            for c in used
        )
        text += f""",
{rows}_cells AS (SELECT k, node, c, lab, val, sum(grad) AS g, count(*) AS h FROM ({cells}) GROUP BY ALL),
{rows}_whole AS (SELECT k, node, sum(p - y) AS g, count(*) AS h FROM {rows} WHERE drawn AND node >= {1 << level} GROUP BY ALL),
{rows}_sides AS (
  SELECT k, node, c, lab, val, sum(g) OVER s AS gl, sum(h) OVER s AS hl FROM {rows}_cells WHERE lab IS NULL
  WINDOW s AS (PARTITION BY k, node, c ORDER BY val)
  UNION ALL SELECT k, node, c, lab, val, w.g - x.g, w.h - x.h FROM {rows}_cells x JOIN {rows}_whole w USING (k, node)
  WHERE lab IS NOT NULL),
{rows}_best AS (
  SELECT k, node, c, lab, val, -gl / (hl + 1) AS wl, -(g - gl) / (h - hl + 1) AS wr,
    round(gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1), 9) AS gain
  FROM {rows}_sides JOIN {rows}_whole USING (k, node) WHERE hl >= 1 AND h - hl >= 1
  QUALIFY gain > 0 AND row_number() OVER (PARTITION BY k, node ORDER BY gain DESC, c, coalesce(lab, ''), val) = 1),
{rows}_moved AS (
  SELECT r.*, b.c, b.wl, b.wr, CASE {' '.join(
      f"WHEN b.c = '{c}' THEN " + (f"coalesce(r.{c} <> b.lab, true)" if c in labels else f"r.{c} <= b.val") for c in used
  )} END AS goes_left
  FROM {rows} r LEFT JOIN {rows}_best b ON r.k = b.k AND r.node = b.node),
{t}_{level + 1} AS (
  SELECT * EXCLUDE (node, w, c, wl, wr, goes_left),
    CASE WHEN c IS NULL THEN node WHEN goes_left THEN 2 * node ELSE 2 * node + 1 END AS node,
    CASE WHEN c IS NULL THEN w WHEN goes_left THEN wl ELSE wr END AS w
  FROM {rows}_moved)"""
    return text + f""",
t{number + 1} AS (SELECT * EXCLUDE (node, w, drawn) REPLACE (p + {rate} * w AS p) FROM {t}_{depth})"""


def boosted(labels: list[str], numbers: list[str], rounds: int, depth: int, rate: float, before: str = ROWS) -> str:
    """Ends in ``boosted`` (model, k, id, y, p) of the asked rows."""
    text = f"""{before},
t0 AS (
  SELECT use, k, id, role_category, description_length, n_skills_total, y, base AS p FROM (
    SELECT 'known' AS use, * FROM known UNION ALL BY NAME SELECT 'asked' AS use, * FROM asked)
  JOIN (SELECT k, avg(y) AS base FROM known GROUP BY 1) USING (k))"""
    text += "".join(_tree(n, depth, labels, numbers, rate) for n in range(rounds))
    return text + f""",
boosted AS (SELECT 'boosted_trees' AS model, k, id, y, p FROM t{rounds} WHERE use = 'asked')"""


R2 = "1 - sum((y - p) ^ 2) / sum((y - m) ^ 2)"


def scores(source: str) -> str:
    """``fits`` (model, k, r2) of a table (model, k, id, y, p)."""
    return f"""fits AS (SELECT model, k, {R2} AS r2 FROM (
  SELECT *, avg(y) OVER (PARTITION BY model, k) AS m FROM {source}) GROUP BY 1, 2)"""
