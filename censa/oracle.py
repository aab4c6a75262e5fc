"""DuckDB SQL that recomputes the registered queries from their definitions.

These strings are the independent check of the Spark plans: they follow the
textbook formulas row by row (z-scores, cumulative windows, plain joins)
rather than the moment sums and range-partitioned running sums used on
Spark. Every double is rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from .functions.stats import normal_quantile

R = 6  # decimals kept in compared doubles


def _crit_cte(level: float) -> str:
    """t critical value from the design's degrees of freedom.

    Cornish-Fisher expansion of the t quantile around the normal one
    (Abramowitz & Stegun 26.7.5), exact to far below 1e-6 for df > 30.
    """
    z = repr(normal_quantile((1.0 + level) / 2.0))
    return f"""crit AS (
  SELECT z + (pow(z,3) + z) / (4*d)
           + (5*pow(z,5) + 16*pow(z,3) + 3*z) / (96*pow(d,2))
           + (3*pow(z,7) + 19*pow(z,5) + 17*pow(z,3) - 15*z) / (384*pow(d,3))
           + (79*pow(z,9) + 776*pow(z,7) + 1482*pow(z,5) - 1920*pow(z,3) - 945*z) / (92160*pow(d,4)) AS t
  FROM (SELECT CAST({z} AS DOUBLE) AS z, CAST(df AS DOUBLE) AS d FROM design) s)"""


def _nsd(a: str, b: str, cols) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


def _domains(groups, where: str, xexpr: str) -> str:
    parts = ["SELECT CAST(NULL AS VARCHAR) AS group_var, CAST(NULL AS VARCHAR) AS gval, "
             f"h, w, {xexpr} AS x FROM base WHERE {where}"]
    for g in groups:
        parts.append(f"SELECT '{g}', CAST({g} AS VARCHAR), h, w, {xexpr} FROM base WHERE {where}")
    return "\n  UNION ALL ".join(parts)


def _head(table: str, strata: str | None, weight: str | None, cols, level: float) -> str:
    h = strata if strata else "CAST(NULL AS VARCHAR)"
    w = f"CAST({weight} AS DOUBLE)" if weight else "CAST(1.0 AS DOUBLE)"
    return f"""WITH base AS (SELECT {h} AS h, {w} AS w, {', '.join(cols)} FROM {table}),
nh AS (SELECT h, count(*) AS n_h FROM base GROUP BY h),
design AS (SELECT sum(n_h) - count(*) AS df FROM nh),
{_crit_cte(level)}"""


_VAR = ("sum(CASE WHEN nh.n_h > 1 THEN nh.n_h / (nh.n_h - 1.0) * (zh.szz - zh.sz * zh.sz / nh.n_h) "
        "ELSE 0.0 END)")


def _out(atype: str, var: str, value: str, stat: str, se: str, n: str, n_total: str,
         n_w: str, n_w_total: str, level: float, low: str | None = None,
         upp: str | None = None) -> str:
    low = low or f"{stat} - crit.t * {se}"
    upp = upp or f"{stat} + crit.t * {se}"
    return f"""SELECT '{atype}' AS analysis_type, '{var}' AS analysis_var, {value} AS analysis_var_value,
  e.group_var AS group_var, e.gval AS group_var_value,
  round({stat}, {R}) AS stat, round({low}, {R}) AS stat_low, round({upp}, {R}) AS stat_upp,
  CAST({n} AS BIGINT) AS n, CAST({n_total} AS BIGINT) AS n_total,
  round({n_w}, {R}) AS n_w, round({n_w_total}, {R}) AS n_w_total, CAST({level} AS DOUBLE) AS level"""


def _logit_bounds(p: str, se: str) -> tuple[str, str]:
    half = f"crit.t * {se} / ({p} * (1 - {p}))"
    lg = f"ln({p} / (1 - {p}))"
    inner = f"{p} > 0 AND {p} < 1"
    return (f"CASE WHEN {inner} THEN 1 / (1 + exp(-({lg} - {half}))) END",
            f"CASE WHEN {inner} THEN 1 / (1 + exp(-({lg} + {half}))) END")


def survey_prop_sql(table, strata, weight, var, groups, level=0.95, multi=False,
                    ci_method="wald") -> str:
    """Proportions. ``multi``: ``var`` holds blank-separated choices; every
    token seen anywhere in the table is a choice of every domain."""
    head = _head(table, strata, weight, [var] + list(groups), level)
    if multi:
        dom = _domains(groups, f"{var} IS NOT NULL", f"regexp_split_to_array(trim({var}), '\\s+')")
        hit = "list_contains(d.x, v.v)"
        vals = ("SELECT DISTINCT d.group_var, d.gval, c.v FROM dom d, "
                f"(SELECT DISTINCT unnest(regexp_split_to_array(trim({var}), '\\s+')) AS v FROM base"
                f" WHERE {var} IS NOT NULL) c WHERE c.v <> ''")
        atype = "prop_select_multiple"
    else:
        dom = _domains(groups, f"{var} IS NOT NULL", f"CAST({var} AS VARCHAR)")
        hit = "d.x = v.v"
        vals = "SELECT DISTINCT group_var, gval, x AS v FROM dom"
        atype = "prop_select_one"
    k = ["group_var", "gval"]
    bounds = (_logit_bounds("(e.wy / e.wt)", "sqrt(greatest(vr.var, 0.0))")
              if ci_method == "logit" else (None, None))
    return f"""{head},
dom AS ({dom}),
vals AS ({vals}),
est AS (
  SELECT d.group_var, d.gval, v.v, sum(d.w) AS wt,
         sum(CASE WHEN {hit} THEN d.w ELSE 0.0 END) AS wy,
         count(*) AS n_total, count(*) FILTER (WHERE {hit}) AS n
  FROM dom d JOIN vals v ON {_nsd('d', 'v', k)}
  GROUP BY d.group_var, d.gval, v.v),
zs AS (
  SELECT e.group_var, e.gval, e.v, d.h,
         d.w * ((CASE WHEN {hit.replace('v.v', 'e.v')} THEN 1.0 ELSE 0.0 END) - e.wy / e.wt) / e.wt AS z
  FROM dom d JOIN est e ON {_nsd('d', 'e', k)}),
zh AS (SELECT group_var, gval, v, h, sum(z) AS sz, sum(z * z) AS szz FROM zs GROUP BY group_var, gval, v, h),
vr AS (SELECT zh.group_var, zh.gval, zh.v, {_VAR} AS var
       FROM zh JOIN nh ON zh.h IS NOT DISTINCT FROM nh.h GROUP BY zh.group_var, zh.gval, zh.v)
{_out(atype, var, 'e.v', 'e.wy / e.wt', 'sqrt(greatest(vr.var, 0.0))', 'e.n', 'e.n_total',
      'e.wy', 'e.wt', level, *bounds)}
FROM est e JOIN vr ON {_nsd('e', 'vr', k + ['v'])} CROSS JOIN crit"""


def survey_mean_sql(table, strata, weight, var, groups, level=0.95) -> str:
    head = _head(table, strata, weight, [var] + list(groups), level)
    dom = _domains(groups, f"{var} IS NOT NULL", f"CAST({var} AS DOUBLE)")
    k = ["group_var", "gval"]
    return f"""{head},
dom AS ({dom}),
est AS (SELECT group_var, gval, sum(w) AS wt, sum(w * x) AS wy, count(*) AS n
        FROM dom GROUP BY group_var, gval),
zs AS (SELECT e.group_var, e.gval, d.h, d.w * (d.x - e.wy / e.wt) / e.wt AS z
       FROM dom d JOIN est e ON {_nsd('d', 'e', k)}),
zh AS (SELECT group_var, gval, h, sum(z) AS sz, sum(z * z) AS szz FROM zs GROUP BY group_var, gval, h),
vr AS (SELECT zh.group_var, zh.gval, {_VAR} AS var
       FROM zh JOIN nh ON zh.h IS NOT DISTINCT FROM nh.h GROUP BY zh.group_var, zh.gval)
{_out('mean', var, 'CAST(NULL AS VARCHAR)', 'e.wy / e.wt', 'sqrt(greatest(vr.var, 0.0))',
      'e.n', 'e.n', 'e.wt', 'e.wt', level)}
FROM est e JOIN vr ON {_nsd('e', 'vr', k)} CROSS JOIN crit"""


def survey_median_sql(table, strata, weight, var, groups, level=0.95) -> str:
    head = _head(table, strata, weight, [var] + list(groups), level)
    dom = _domains(groups, f"{var} IS NOT NULL", f"CAST({var} AS DOUBLE)")
    k = ["group_var", "gval"]
    return f"""{head},
dom AS ({dom}),
dist AS (SELECT group_var, gval, x AS y, sum(w) AS ws, count(*) AS c FROM dom GROUP BY group_var, gval, x),
cum AS (SELECT *, sum(ws) OVER (PARTITION BY group_var, gval ORDER BY y
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cw FROM dist),
tot AS (SELECT group_var, gval, max(cw) AS wt, sum(c) AS n, max(y) AS ymax FROM cum GROUP BY group_var, gval),
med AS (SELECT c.group_var, c.gval, min(c.y) AS m FROM cum c JOIN tot t ON {_nsd('c', 't', k)}
        WHERE c.cw >= 0.5 * t.wt GROUP BY c.group_var, c.gval),
sh AS (SELECT d.group_var, d.gval, sum(d.w) AS ws, sum(CASE WHEN d.x <= m.m THEN d.w ELSE 0.0 END) AS a
       FROM dom d JOIN med m ON {_nsd('d', 'm', k)} GROUP BY d.group_var, d.gval),
zs AS (SELECT d.group_var, d.gval, d.h,
              d.w * ((CASE WHEN d.x <= m.m THEN 1.0 ELSE 0.0 END) - s.a / s.ws) / s.ws AS z
       FROM dom d JOIN med m ON {_nsd('d', 'm', k)} JOIN sh s ON {_nsd('d', 's', k)}),
zh AS (SELECT group_var, gval, h, sum(z) AS sz, sum(z * z) AS szz FROM zs GROUP BY group_var, gval, h),
vr AS (SELECT zh.group_var, zh.gval, {_VAR} AS var
       FROM zh JOIN nh ON zh.h IS NOT DISTINCT FROM nh.h GROUP BY zh.group_var, zh.gval),
bnd AS (SELECT vr.group_var, vr.gval, 0.5 - crit.t * sqrt(greatest(vr.var, 0.0)) AS p_low,
               0.5 + crit.t * sqrt(greatest(vr.var, 0.0)) AS p_up FROM vr CROSS JOIN crit),
lim AS (SELECT c.group_var, c.gval,
               min(CASE WHEN c.cw >= b.p_low * t.wt THEN c.y END) AS lo,
               min(CASE WHEN c.cw >= b.p_up * t.wt THEN c.y END) AS hi
        FROM cum c JOIN tot t ON {_nsd('c', 't', k)} JOIN bnd b ON {_nsd('c', 'b', k)}
        GROUP BY c.group_var, c.gval),
e AS (SELECT m.group_var, m.gval, m.m, t.n, t.wt, t.ymax, l.lo, l.hi
      FROM med m JOIN tot t ON {_nsd('m', 't', k)} JOIN lim l ON {_nsd('m', 'l', k)})
{_out('median', var, 'CAST(NULL AS VARCHAR)', 'e.m', '0', 'e.n', 'e.n', 'e.wt', 'e.wt', level,
      low='e.lo', upp='coalesce(e.hi, e.ymax)')}
FROM e"""
