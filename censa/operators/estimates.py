"""Weighted survey estimates for every listed analysis in one plan (W5).

Definitions (Taylor linearisation, every row its own unit, strata optional):

* domain D of analysis variable y and group value g: rows with y not NULL
  and the group column equal to g (overall: all rows with y not NULL);
* ``W = sum_D w``; ``stat = sum_D w*y / W``; a single-choice value v uses
  ``y = 1[x = v]``, a multi-choice member its 0/1 column;
* ``z_i = 1_D * w_i * (y_i - stat) / W`` and
  ``Var = sum_h n_h/(n_h-1) * (sum_h z^2 - (sum_h z)^2 / n_h)`` with ``n_h``
  the full-design size of stratum h;
* ``stat_low/stat_upp = stat -/+ t(level, n - H) * SE`` (not clipped);
* median: smallest value whose cumulative weight reaches W/2; limits invert
  the weighted distribution at ``0.5 -/+ t * SE(F(median))``.

Execution: analyses are grouped into cells of a (variable, group column) pair
(``cells``); analyses that differ in their level alone share one. The sums of
all cells come from one pass (``moments``), and every later step works on
them. The variance is expanded into sums that exist per stratum; strata that
lie in one task are finished there, the others here by grouped aggregates and
joins. Medians are found by selection (``selection``): one exchange of
histograms and one of the values in a window.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..design import H, W, DesignInfo, SurveyDesign, design_table, prepared
from ..functions.stats import two_sided_crit
from .cells import Cells, Variable, at, records
from .moments import cell_sums
from .selection import BUCKETS, DOMAIN, LIMIT, window_sums

TYPES = ("prop_select_one", "prop_select_multiple", "mean", "median")

RESULT_COLUMNS = ["analysis_type", "analysis_var", "analysis_var_value", "group_var",
                  "group_var_value", "stat", "stat_low", "stat_upp", "n", "n_total",
                  "n_w", "n_w_total", "level"]


@dataclass(frozen=True)
class Analysis:
    analysis_var: str
    analysis_type: str
    level: float = 0.95
    group_var: str | None = None


def as_analyses(loa) -> list[Analysis]:
    """LOA rows from a DataFrame (collected: it is a plan of a few hundred
    rows), a list of dicts/tuples, or Analysis objects."""
    if isinstance(loa, DataFrame):
        loa = [r.asDict() for r in loa.collect()]
    out = []
    for r in loa:
        if isinstance(r, Analysis):
            out.append(r)
        elif isinstance(r, dict):
            lvl = r.get("level")
            out.append(Analysis(r["analysis_var"], r["analysis_type"],
                                0.95 if lvl is None else float(lvl), r.get("group_var")))
        else:
            out.append(Analysis(*r))
    return out


def plan_analyses(df: DataFrame, loa, sm_sep: str = "/", choices: str = "columns"):
    """Keep analyses whose variable (and group) exist in the data, drop
    self-disaggregations. Returns (kept, dropped-with-reason)."""
    cols = set(df.columns)
    kept, dropped = [], []
    for a in as_analyses(loa):
        if a.analysis_type not in TYPES:
            dropped.append((a, f"unknown analysis_type {a.analysis_type!r}"))
        elif a.analysis_var not in cols:
            dropped.append((a, "variable not in data"))
        elif a.group_var is not None and a.group_var not in cols:
            dropped.append((a, "group variable not in data"))
        elif a.group_var is not None and a.group_var == a.analysis_var:
            dropped.append((a, "variable is its own group"))
        elif choices == "columns" and a.analysis_type == "prop_select_multiple" and not members(df, a.analysis_var, sm_sep):
            dropped.append((a, "no member columns"))
        else:
            kept.append(a)
    return kept, dropped


def members(df: DataFrame, parent: str, sm_sep: str = "/") -> list[tuple[str, str]]:
    """(column, choice) pairs of the 0/1 member columns ``parent<sep>choice``."""
    pre = parent + sm_sep
    return [(c, c[len(pre):]) for c in df.columns if c.startswith(pre) and len(c) > len(pre)]


def _constants(values, dtype: str) -> Column:
    """A constant array, from one literal however long it is."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{dtype}>")


def _pick(values, dtype: str, idx: Column) -> Column:
    """values[idx] for a small per-analysis constant list."""
    return at(_constants(values, dtype), idx)


def _nsjoin(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be NULL (NULL matches NULL); keeps left's keys."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys]
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def survey_results(df: DataFrame, design: SurveyDesign, loa, sm_sep: str = "/",
                   range_partitions: int | None = None, ci_method: str = "wald",
                   choices: str = "columns") -> DataFrame:
    """Long results table: one row per (analysis, choice, group value).

    Columns: analysis_type, analysis_var, analysis_var_value, group_var,
    group_var_value, stat, stat_low, stat_upp, n, n_total, n_w, n_w_total,
    level. The design (stratum sizes, NULL weights, centres of means, ranges
    of medians) is checked before the estimates are planned: from a small
    design pass for means and medians, otherwise from design records in the
    main aggregate. Medians take no negative weights.
    ``ci_method='logit'`` gives proportions the interval
    ``expit(logit(p) -/+ t * SE / (p (1 - p)))`` (NULL at p = 0 or 1); means
    and medians keep theirs. ``choices='text'`` reads the choices of
    select-multiple variables from their packed answers instead of member
    columns: choices are found and summed as data, so there may be any number
    of them; one that nobody of a group value chose has no row there.
    ``range_partitions`` is the number of ranges into which a median's domain
    is cut per pass.
    """
    if ci_method not in ("wald", "logit"):
        raise ValueError("ci_method must be 'wald' or 'logit'")
    if choices not in ("columns", "text"):
        raise ValueError("choices must be 'columns' or 'text'")
    design.check(df)
    analyses, _ = plan_analyses(df, loa, sm_sep, choices)
    if not analyses:
        raise ValueError("no analysis in the list applies to the data")
    moments, medians = Cells(), Cells()
    for aid, a in enumerate(analyses):
        listed: tuple | None = ()
        if a.analysis_type == "prop_select_multiple":
            listed = None if choices == "text" else tuple(members(df, a.analysis_var, sm_sep))
        plan = medians if a.analysis_type == "median" else moments
        plan.add(aid, Variable(a.analysis_var, a.analysis_type, listed), a.group_var)
    mean_vars = sorted({v.name for v in moments.variables if v.kind == "mean"})
    median_vars = sorted({v.name for v in medians.variables})
    # Means are centred before summing and medians need their ranges, so these
    # take a design pass first. Without them, the design counts ride along in
    # the main aggregate (one record per row), saving a scan.
    merged = not mean_vars and not median_vars
    centres: dict[str, float] = {}
    info = sizes = None
    ranges: dict[str, tuple[float, float]] = {}
    if not merged:
        info, centres, sizes, ranges = design_table(df, design, mean_vars, median_vars)
        _check_design(info, design, bool(median_vars))

    def base(plan: Cells) -> DataFrame:
        needed = [*plan.groups, *(v.name for v in plan.variables)]
        needed += [c for v in plan.variables for c, _ in v.choices or ()]
        return prepared(df, design, needed)

    def moment_sums():
        by_vid = {vid: centres[v.name] for vid, v in enumerate(moments.variables) if v.kind == "mean"}
        return cell_sums(base(moments), moments, by_vid, design.strata is None, merged)

    def median_windows():
        # a stratum's factor is at most 2: n / (n - 1) from two rows on
        widest = [max((crit[a] for a in aids if crit[a] == crit[a]), default=0.0) * 2 ** 0.5 for aids in medians.analyses]
        return window_sums(records(base(medians), medians),
                           [ranges[medians.variables[vid].name] for vid, _ in medians.cells], widest,
                           max(2, range_partitions or BUCKETS), LIMIT)

    sums = None
    if merged:
        sums = moment_sums()
        info, sizes = _design_from_sums(sums)
        _check_design(info, design)
    by_level = {a.level: two_sided_crit(a.level, info.df) if info.df > 0 else float("nan") for a in analyses}
    crit = [by_level[a.level] for a in analyses]
    with ThreadPoolExecutor(2) as pool:  # two passes that do not need each other
        window = pool.submit(median_windows) if medians.cells else None
        if moments.cells and not merged:
            sums = moment_sums()
    if design.strata is None:
        # one stratum: the factors are constants, so no join with a one-row table
        n = info.n
        sizes = (float(n) / (n - 1) if n > 1 else 0.0, 1.0 / (n - 1) if n > 1 else 0.0)
    meta = dict(
        types=[a.analysis_type for a in analyses], vars=[a.analysis_var for a in analyses],
        groups=[a.group_var for a in analyses], levels=[float(a.level) for a in analyses],
        crit=crit, centre=[centres.get(a.analysis_var, 0.0) if a.analysis_type == "mean" else 0.0
                           for a in analyses])
    parts = []
    if sums is not None:
        parts.append(_moment_estimates(sums, sizes, moments, meta, ci_method))
    if window is not None:
        parts.append(_median_estimates(window.result(), sizes, medians, meta))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _check_design(info: DesignInfo, design: SurveyDesign, medians: bool = False) -> None:
    if info.null_weights:
        raise ValueError(f"{info.null_weights} row(s) have a NULL or non-numeric weight")
    if medians and info.negative_weights:
        raise ValueError(f"{info.negative_weights} row(s) have a negative weight: medians are not defined")
    if info.lonely_strata and design.lonely == "fail":
        raise ValueError(f"{info.lonely_strata} stratum/strata hold a single row; "
                         "use SurveyDesign(lonely='skip') to let them add zero variance")


def _design_from_sums(sums: DataFrame):
    """Design summary and per-stratum factors from the design rows of the
    stored sums (one row per stratum)."""
    n_h = F.col("x0")
    d = (sums.where(F.col("part") == "design")
             .select(F.col("h").alias(H), n_h.alias("n_h"), F.col("x1").alias("nw"),
                     F.when(n_h > 1, n_h / (n_h - 1)).otherwise(0.0).alias("__f"),
                     F.when(n_h > 1, 1.0 / (n_h - 1)).otherwise(0.0).alias("__g")))
    row = d.agg(F.count(F.lit(1)).alias("H"), F.sum("n_h").alias("n"),
                F.sum(F.when(F.col("n_h") == 1, 1).otherwise(0)).alias("lonely"),
                F.sum("nw").alias("nw")).first()
    info = DesignInfo(int(row["n"] or 0), int(row["H"] or 0), int(row["lonely"] or 0),
                      int(row["nw"] or 0))
    return info, d.select(H, "n_h", "__f", "__g")


def _with_factors(df: DataFrame, sizes) -> DataFrame:
    """Attach the stratum factors __f, __g: a join with the per-stratum
    table, or literals when the design has a single stratum."""
    if isinstance(sizes, tuple):
        return df.withColumn("__f", F.lit(sizes[0])).withColumn("__g", F.lit(sizes[1]))
    return _nsjoin(df, sizes.drop("n_h").withColumn(H, F.col(H).cast("string")), [H])


def _variance(p, fQ, fB, fT, gAA, gAS, gSS, Wt) -> Column:
    num = (fQ - 2 * p * fB + p * p * fT) - (gAA - 2 * p * gAS + p * p * gSS)
    return F.try_divide(F.greatest(num, F.lit(0.0)), Wt * Wt)


def _per_analysis(cells: DataFrame, plan: Cells) -> DataFrame:
    """A row of a cell for each of its analyses (``aid``)."""
    return cells.withColumn("aid", F.explode(at(_constants(plan.analyses, "array<int>"), F.col("cid"))))


def _named(sums: DataFrame, part: str, *names: str) -> DataFrame:
    return (sums.where(F.col("part") == part).withColumnsRenamed({f"x{i}": n for i, n in enumerate(names)})
            .withColumnRenamed("h", H).select(*DOMAIN, "val", H, *names))


def _moment_estimates(sums, sizes, plan: Cells, meta, ci_method: str = "wald") -> DataFrame:
    """Estimates from the sums of cells. Strata that are still open are joined
    with their domain's sums in that stratum; no step holds all values of a
    domain in one task (a free-text column analysed as single-choice has as
    many values as rows). Listed choices that nobody took get their zero rows
    from the domains."""
    domain = _with_factors(_named(sums, "domain", "SD", "TD", "nD"), sizes)
    SD = F.col("SD")
    dom_names = ["Wt", "fT", "gSS", "n_total"]
    dom = (domain.select(*DOMAIN, SD.alias("Wt"), (F.col("__f") * F.col("TD")).alias("fT"),
                         (F.col("__g") * SD * SD).alias("gSS"), F.col("nD").alias("n_total"))
           .unionByName(_named(sums, "domain_closed", *dom_names).drop("val", H))
           .groupBy(*DOMAIN).agg(*[F.sum(c).alias(c) for c in dom_names]))
    names = ["sumA", "fB", "fQ", "gAA", "gAS", "n_y", "n_c"]
    A, f, g = F.col("sumA"), F.col("__f"), F.col("__g")
    choice = _nsjoin(_named(sums, "choice", "sumA", "B", "Q", "n_y", "n_c"), domain.select(*DOMAIN, H, "SD", "__f", "__g"), [*DOMAIN, H])
    vals = (choice.select(*DOMAIN, "val", "sumA", (f * F.col("B")).alias("fB"), (f * F.col("Q")).alias("fQ"),
                          (g * A * A).alias("gAA"), (g * A * SD).alias("gAS"), "n_y", "n_c")
            .unionByName(_named(sums, "choice_closed", *names).drop(H))
            .groupBy(*DOMAIN, "val").agg(*[F.sum(c).alias(c) for c in names]))
    listed = [plan.variables[vid].choices if plan.variables[vid].kind == "prop_select_multiple" else None
              for vid, _ in plan.cells]
    if any(c is not None for c in listed):
        from_list = _pick([c is not None for c in listed], "boolean", F.col("cid"))
        every = _pick([[name for _, name in c or ()] for c in listed], "array<string>", F.col("cid"))
        some = _nsjoin(dom.where(from_list).withColumn("val", F.explode(every)), vals.where(from_list), [*DOMAIN, "val"], "left")
        res = _nsjoin(vals.where(~from_list), dom, DOMAIN)
        res = res.unionByName(some.fillna(0.0, names).select(*res.columns))
    else:
        res = _nsjoin(vals, dom, DOMAIN)
    res = _per_analysis(res, plan)
    aid = F.col("aid")
    Wt = F.col("Wt")
    p = F.try_divide(F.col("sumA"), Wt)  # NULL for a domain of zero weight
    se = F.sqrt(_variance(p, F.col("fQ"), F.col("fB"), F.col("fT"), F.col("gAA"),
                          F.col("gAS"), F.col("gSS"), Wt))
    typ = _pick(meta["types"], "string", aid)
    is_mean = typ == F.lit("mean")
    stat = p + _pick(meta["centre"], "double", aid)
    crit = _pick(meta["crit"], "double", aid)
    low, upp = stat - crit * se, stat + crit * se
    if ci_method == "logit":
        inner = (p > 0) & (p < 1)
        lg = F.log(F.try_divide(p, 1 - p))
        half = F.try_divide(crit * se, p * (1 - p))
        expit = lambda x: F.lit(1.0) / (F.lit(1.0) + F.exp(-x))
        low = F.when(is_mean, low).when(inner, expit(lg - half))
        upp = F.when(is_mean, upp).when(inner, expit(lg + half))
    return res.select(
        typ.alias("analysis_type"), _pick(meta["vars"], "string", aid).alias("analysis_var"),
        F.col("val").alias("analysis_var_value"),
        _pick(meta["groups"], "string", aid).alias("group_var"),
        F.col("gval").alias("group_var_value"),
        stat.alias("stat"), low.alias("stat_low"), upp.alias("stat_upp"),
        F.when(is_mean, F.col("n_c")).otherwise(F.col("n_y")).cast("long").alias("n"),
        F.col("n_total").cast("long").alias("n_total"),
        F.when(is_mean, Wt).otherwise(F.col("sumA")).alias("n_w"),
        Wt.alias("n_w_total"), _pick(meta["levels"], "double", aid).alias("level"))


def _median_estimates(window: DataFrame, sizes, plan: Cells, meta) -> DataFrame:
    """Medians and their limits from the stored window sums. A domain's values
    in the window are few (``selection``), so their running weight is a plain
    window; it starts from the weight below."""
    inside, by = F.col("side") == 0, Window.partitionBy(*DOMAIN)
    tot = window.groupBy(*DOMAIN).agg(F.sum("ws").alias("Wt"), F.sum("n").alias("n_total"),
                                      F.sum(F.when(F.col("side") < 0, F.col("ws")).otherwise(0.0)).alias("below"))
    cum = _nsjoin(window.where(inside).groupBy(*DOMAIN, "y").agg(F.sum("ws").alias("ws")), tot, DOMAIN)
    cum = cum.withColumn("C", F.col("below") + F.sum("ws").over(
        by.orderBy("y").rowsBetween(Window.unboundedPreceding, 0)))
    med = cum.groupBy(*DOMAIN).agg(F.min(F.when(F.col("C") >= 0.5 * F.col("Wt"), F.col("y"))).alias("m"))

    # SE of the weighted share of the domain at or below the median
    at_most = (F.col("side") < 0) | (inside & (F.col("y") <= F.col("m")))
    ind = F.when(at_most, 1.0).otherwise(0.0)
    per_h = (_nsjoin(window, med, DOMAIN).groupBy(*DOMAIN, H)
             .agg(F.max("m").alias("m"), F.sum(F.col("ws") * ind).alias("A"), F.sum(F.col("tt") * ind).alias("B"),
                  F.sum("ws").alias("S"), F.sum("tt").alias("T")))
    per_h = _with_factors(per_h, sizes)
    f, g, A, S = F.col("__f"), F.col("__g"), F.col("A"), F.col("S")
    share = (per_h.groupBy(*DOMAIN)
                  .agg(F.max("m").alias("m"), F.sum(A).alias("sumA"), F.sum(S).alias("Ws"),
                       F.sum(f * F.col("B")).alias("fB"), F.sum(f * F.col("T")).alias("fT"),
                       F.sum(g * A * A).alias("gAA"), F.sum(g * A * S).alias("gAS"),
                       F.sum(g * S * S).alias("gSS")))
    share = share.withColumn("p", F.try_divide(F.col("sumA"), F.col("Ws")))
    se = F.sqrt(_variance(F.col("p"), F.col("fB"), F.col("fB"), F.col("fT"), F.col("gAA"),
                          F.col("gAS"), F.col("gSS"), F.col("Ws")))
    aid = F.col("aid")
    bounds = (_per_analysis(share.select(*DOMAIN, "m", se.alias("se")), plan)
              .select("aid", *DOMAIN, "m", (_pick(meta["crit"], "double", aid) * F.col("se")).alias("half")))
    limit = lambda share: F.min(F.when(F.col("C") >= share * F.col("Wt"), F.col("y")))
    res = (_nsjoin(cum, bounds, DOMAIN).groupBy("aid", "gval")
           .agg(F.max(F.when(F.col("Wt") != 0, F.col("m"))).alias("m"), F.max("Wt").alias("Wt"),
                F.max("n_total").alias("n_total"), limit(F.lit(0.5) - F.col("half")).alias("lo"),
                # a limit above all of the domain's weight is its largest value
                F.coalesce(limit(F.lit(0.5) + F.col("half")), F.max(F.when(~F.isnan("half"), F.col("y")))).alias("hi")))
    return res.select(
        _pick(meta["types"], "string", aid).alias("analysis_type"),
        _pick(meta["vars"], "string", aid).alias("analysis_var"),
        F.lit(None).cast("string").alias("analysis_var_value"),
        _pick(meta["groups"], "string", aid).alias("group_var"),
        F.col("gval").alias("group_var_value"),
        F.col("m").alias("stat"), F.col("lo").alias("stat_low"),
        F.col("hi").alias("stat_upp"),
        F.col("n_total").cast("long").alias("n"), F.col("n_total").cast("long").alias("n_total"),
        F.col("Wt").alias("n_w"), F.col("Wt").alias("n_w_total"),
        _pick(meta["levels"], "double", aid).alias("level"))
