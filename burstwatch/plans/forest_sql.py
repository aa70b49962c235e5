"""The forest in SQL: the same draws, the same trees and the same scores, level by level."""

from __future__ import annotations

from burstwatch.operators.forest import CONTAMINATION, EULER_GAMMA, SAMPLE, SEED, THINNING, TREES
from burstwatch.schemas import FEATURES

HEIGHT = (SAMPLE - 1).bit_length()


def _path(n: str) -> str:
    return f"(CASE WHEN {n} <= 1 THEN 0e0 WHEN {n} = 2 THEN 1e0 ELSE 2e0 * (ln({n} - 1e0) + {EULER_GAMMA}e0) - 2e0 * ({n} - 1e0) / {n} END)"


def _hex(text: str, first: int, digits: int) -> str:
    return f"CAST('0x' || substr({text}, {first}, {digits}) AS BIGINT)"


def forest_sql(training: str, scored: str) -> str:
    """CTEs from ``training`` and ``scored``, tables with the features, to ``scores`` and ``training_scores``.

    Both have the features as the list ``x`` and ``anomaly_score``; one row for each different list.
    Needs at least as many training rows as a sample has.
    """
    vector = "[" + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0e0)" for c in FEATURES) + "]"
    text = "array_to_string(list_transform(x, lambda v: CAST(floor(v) AS BIGINT) || ':' || CAST(floor((v - floor(v)) * 1099511627776e0) AS BIGINT)), ':')"
    parts = [f"""
  f_rows AS (SELECT {vector} AS x, count(*) AS copies FROM {training} GROUP BY 1),
  f_size AS (SELECT sum(copies) AS n, least({TREES}, CAST(ceil({THINNING * SAMPLE * TREES} / sum(copies)) AS BIGINT)) AS groups FROM f_rows),
  f_offered AS (SELECT x, g, ({TREES - 1} - g) // groups + 1 AS members, groups,
      {_hex(f"md5('{SEED}:' || md5({text}) || ':' || copy || ':' || g)", 1, 15)} AS number
    FROM (SELECT x, groups, copy, unnest(range(groups)) AS g FROM (SELECT x, groups, unnest(range(copies)) AS copy FROM f_rows, f_size))),
  f_drawn AS (SELECT x, tree FROM (
    SELECT x, tree, row_number() OVER (PARTITION BY tree ORDER BY draw, x) AS r
    FROM (SELECT x, g + groups * (number % members) AS tree, number // members AS draw FROM f_offered)) WHERE r <= {SAMPLE}),
  points0 AS MATERIALIZED (SELECT tree, 1 AS place, x FROM f_drawn)"""]
    k = len(FEATURES)
    lows, highs = (", ".join(f"{f}(x[{i}])" for i in range(1, k + 1)) for f in ("min", "max"))
    for level in range(HEIGHT + 1):
        stop = "true" if level == HEIGHT else "len(s) = 0"
        parts.append(f"""
  nodes{level} AS MATERIALIZED (SELECT tree, place, n, {stop} AS leaf, {level} + {_path("n")} AS path, f,
      CASE WHEN lo[f] + u * (hi[f] - lo[f]) >= hi[f] THEN lo[f] ELSE lo[f] + u * (hi[f] - lo[f]) END AS threshold FROM (
    SELECT *, s[1 + {_hex("d", 1, 8)} % greatest(len(s), 1)] AS f, {_hex("d", 9, 8)} / 4294967296e0 AS u FROM (
      SELECT *, md5('{SEED}:' || tree || ':' || place) AS d, list_filter(range(1, {k + 1}), lambda i: hi[i] > lo[i]) AS s FROM (
        SELECT tree, place, count(*) AS n, [{lows}] AS lo, [{highs}] AS hi FROM points{level} GROUP BY 1, 2))))""")
        if level < HEIGHT:
            parts.append(f"""
  points{level + 1} AS MATERIALIZED (SELECT tree, 2 * place + CAST(x[f] > threshold AS INTEGER) AS place, x
    FROM points{level} JOIN nodes{level} USING (tree, place) WHERE NOT leaf)""")
    parts.append(f"""
  walk0 AS MATERIALIZED (SELECT x, tree, 1 AS place FROM (SELECT x FROM f_rows UNION SELECT {vector} FROM {scored}), range({TREES}) t(tree))""")
    for level in range(HEIGHT):
        parts.append(f"""
  walk{level + 1} AS MATERIALIZED (SELECT x, tree, 2 * place + CAST(x[f] > threshold AS INTEGER) AS place
    FROM walk{level} JOIN nodes{level} USING (tree, place) WHERE NOT leaf)""")
    ends = " UNION ALL ".join(f"SELECT x, path FROM walk{i} JOIN nodes{i} USING (tree, place) WHERE leaf" for i in range(HEIGHT + 1))
    parts.append(f"""
  f_raw AS (SELECT x, -pow(2e0, -(sum(path) / {TREES}) / {_path(str(SAMPLE) + "e0")}) AS score FROM ({ends}) GROUP BY x),
  f_cut AS (SELECT quantile_cont(score, {CONTAMINATION}) AS cut FROM (SELECT score, unnest(range(copies)) FROM f_raw JOIN f_rows USING (x))),
  scores AS (SELECT x, CASE WHEN abs(score - cut) < 1e-12 THEN 0e0 ELSE score - cut END AS anomaly_score FROM f_raw, f_cut),
  scored AS (SELECT s.*, anomaly_score FROM {scored} s JOIN scores ON x = {vector})""")
    return ",".join(parts)
