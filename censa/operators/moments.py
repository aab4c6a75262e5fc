"""Weighted sums of all cells of a plan, as numpy inside Spark tasks.

A row takes part in every (variable, group column) cell, so a plan of hundreds
of analyses makes hundreds of records a row. They are not made: a task reads
its rows as Arrow columns, codes the values of each column once, and adds up a
cell with a few counting passes over the codes.

Variances need the sums of each stratum. With strata, rows are dealt by ranges
of (stratum, row), so a stratum lies in one task, or in several adjacent ones if
it is large; only the first and the last stratum of a task can be shared, and
one of more than CHUNK rows is taken in pieces. All others are *closed*: their
share of the variance is finished in the task, which sends one row per cell,
group value and choice whatever the number of strata. Shared strata are sent
as sums and finished by grouped aggregates and joins (``estimates``). Nothing
is gathered by stratum or domain, so a hot one is no large task.

Kinds of rows (``part``) and their numbers x0, x1, ...:

* ``domain``: of an open stratum: weights, squared weights, rows;
* ``choice``: of an open stratum: A, B, Q (sums of wy, wwy, wwyy), sum of y, rows;
* ``domain_closed``: W, fT, gSS, rows; ``choice_closed``: sum A, fB, fQ, gAA,
  gAS, sum of y, rows (f and g are the stratum factors);
* ``design``: of a stratum: rows, rows without a weight.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..design import H, W
from ..functions.columns import number, q
from ..session import ensure_checkpoint_dir
from .cells import Cells

# the code of this module goes with the task: workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows that are added up at a time.
CHUNK = 1 << 16
NUMBERS = [f"x{i}" for i in range(7)]
SUMS = "part string, cid int, gval string, val string, h string, " + ", ".join(f"{x} double" for x in NUMBERS)


def columns(base: DataFrame, plan: Cells, centres: dict[int, float]) -> DataFrame:
    """The Arrow columns: h, w, g0.. (group values), v0.. (answers)."""
    out = [F.col(H).cast("string").alias("h"), F.col(W).alias("w")]
    out += [F.col(q(g)).cast("string").alias(f"g{k}") for k, g in enumerate(plan.groups)]
    for k, v in enumerate(plan.variables):
        x = F.col(q(v.name))
        if v.kind == "prop_select_one":
            out.append(x.cast("string").alias(f"v{k}"))
        elif v.kind == "mean":  # text that is not a number, and NaN, are not in the domain
            out.append((number(x) - F.lit(centres.get(k, 0.0))).alias(f"v{k}"))
        elif v.choices is None:  # choices are read from the packed answers
            out.append(F.array_distinct(F.split(F.trim(x.cast("string")), r"\s+")).alias(f"v{k}"))
        else:  # chosen options alone
            y = [F.coalesce(number(F.col(q(c))), F.lit(0.0)) for c, _ in v.choices]
            chosen = F.array_compact(F.array(*[F.when(c != 0, F.struct(F.lit(n).alias("k"), c.alias("y"))) for n, c in enumerate(y)]))
            out.append(F.when(x.isNotNull(), chosen).alias(f"v{k}"))
    return base.select(*out)


def coded(column: pa.ChunkedArray) -> tuple[np.ndarray, list]:
    """Codes of a column's values and the values; NULL is one of them."""
    d = pc.dictionary_encode(column.combine_chunks(), null_encoding="encode")
    if isinstance(d, pa.ChunkedArray):
        d = d.combine_chunks()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary.to_pylist()


def added(keys: np.ndarray, size: int, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, rows, sums of the values ...) of the keys that occur."""
    if size > 8 * len(keys) + 1024:
        found, keys = np.unique(keys, return_inverse=True)
        return found, np.bincount(keys, minlength=len(found)), *(np.bincount(keys, v, len(found)) for v in values)
    rows = np.bincount(keys, minlength=size)
    found = np.flatnonzero(rows)
    return found, rows[found], *(np.bincount(keys, v, size)[found] for v in values)


class Chunk:
    """The sums of one chunk of rows; ``closed`` strata are finished."""

    def __init__(self, table: pa.Table, open_strata: set):
        self.table = table
        self.h, self.strata = coded(table.column("h"))
        w = table.column("w").combine_chunks()
        self.no_weight = w.is_null().to_numpy(zero_copy_only=False)
        self.w = w.fill_null(0.0).to_numpy(zero_copy_only=False)
        self.closed = np.array([s not in open_strata for s in self.strata], bool)
        n = np.bincount(self.h, minlength=len(self.strata))
        several = n > 1
        self.f = np.where(several, n / np.maximum(n - 1, 1), 0.0)
        self.g = np.where(several, 1 / np.maximum(n - 1, 1), 0.0)
        self.out: list[pa.RecordBatch] = []

    def put(self, part: str, cid: int | None, gval, val, h, *numbers) -> None:
        n = len(numbers[0])
        if not n:
            return
        text = lambda values, codes: (pa.nulls(n, pa.string()) if values is None
                                      else pa.array(values, pa.string()).take(pa.array(codes)))
        numbers = [pa.array(np.asarray(x, float)) for x in numbers]
        numbers += [pa.nulls(n, pa.float64())] * (len(NUMBERS) - len(numbers))
        self.out.append(pa.RecordBatch.from_arrays(
            [pa.array([part] * n), pa.array([cid] * n, pa.int32()), text(*gval), text(*val), text(*h), *numbers],
            ["part", "cid", "gval", "val", "h", *NUMBERS]))

    def answers(self, vid: int, kind: str, choices):
        """(rows of the domain, rows of the choices, choice codes, values of
        the choices, y or None for 1)."""
        column = self.table.column(f"v{vid}").combine_chunks()
        rows = np.flatnonzero(~column.is_null().to_numpy(zero_copy_only=False))
        if kind == "prop_select_one":
            code, values = coded(pa.chunked_array([column]))
            return rows, rows, code[rows], values, None
        if kind == "mean":
            return rows, rows, np.zeros(len(rows), np.int64), None, column.fill_null(0.0).to_numpy(zero_copy_only=False)[rows]
        of = np.repeat(rows, np.diff(column.offsets.to_numpy())[rows]) if len(rows) else rows
        flat = column.flatten()
        if choices is None:
            code, values = coded(pa.chunked_array([flat]))
            some = code != (values.index("") if "" in values else -1)
            return rows, of[some], code[some], values, None
        return rows, of, flat.field("k").to_numpy(zero_copy_only=False).astype(np.int64), list(choices), flat.field("y").to_numpy(zero_copy_only=False)

    def cell(self, cid: int, group: tuple[np.ndarray, list] | None, answers) -> None:
        rows, of, code, values, y = answers
        g, names = group if group is not None else (None, [None])
        ng, nh, nv = len(names), len(self.strata), max(1, len(values or ()))

        def place(at):  # (stratum, group value)
            return self.h[at] if g is None else self.h[at] * ng + g[at]
        w = self.w[rows]
        dom, rows_d, S, T = added(place(rows), nh * ng, w, w * w)
        wc = self.w[of]
        if y is None:
            key, rows_c, A, B = added(place(of) * nv + code, nh * ng * nv, wc, wc * wc)
            Q, sy = B, rows_c
        else:
            wy = wc * y
            key, rows_c, A, B, Q, sy = added(place(of) * nv + code, nh * ng * nv, wy, wc * wy, wy * wy, y)
        dh, dg = np.divmod(dom, ng)
        hg, v = np.divmod(key, nv)
        ch, cg = np.divmod(hg, ng)
        val = lambda codes: (values, codes)
        none = (None, None)

        o, c = ~self.closed[dh], ~self.closed[ch]
        self.put("domain", cid, (names, dg[o]), none, (self.strata, dh[o]), S[o], T[o], rows_d[o])
        self.put("choice", cid, (names, cg[c]), val(v[c]), (self.strata, ch[c]), A[c], B[c], Q[c], sy[c], rows_c[c])

        o, c = ~o, ~c
        f, g_ = self.f[dh[o]], self.g[dh[o]]
        at, _, W_, fT, gSS, n = added(dg[o], ng, S[o], f * T[o], g_ * S[o] ** 2, rows_d[o])
        self.put("domain_closed", cid, (names, at), none, none, W_, fT, gSS, n)
        SD = S[np.searchsorted(dom, hg[c])]
        f, g_ = self.f[ch[c]], self.g[ch[c]]
        A, B, Q = A[c], B[c], Q[c]
        at, _, *sums = added(cg[c] * nv + v[c], ng * nv, A, f * B, f * Q, g_ * A * A, g_ * A * SD, sy[c], rows_c[c])
        self.put("choice_closed", cid, (names, at // nv), val(at % nv), none, *sums)

    def design(self) -> None:
        at, n, missing = added(self.h, len(self.strata), self.no_weight.astype(float))
        self.put("design", None, (None, None), (None, None), (self.strata, at), n, missing)


def sums_of(plan: Cells, one_stratum: bool, with_design: bool, chunk: int):
    """The function that turns a task's batches (ordered by stratum unless
    there is one alone) into rows of ``SUMS``."""
    variables = [(v.kind, None if v.choices is None else tuple(c for _, c in v.choices)) for v in plan.variables]
    cells, n_groups = list(plan.cells), len(plan.groups)

    def add(table: pa.Table, open_strata: set):
        c = Chunk(table, open_strata)
        if with_design:
            c.design()
        groups = [coded(table.column(f"g{k}")) for k in range(n_groups)]
        for vid, (kind, choices) in enumerate(variables):
            answers = c.answers(vid, kind, choices)
            for cid, (v, gid) in enumerate(cells):
                if v == vid:
                    c.cell(cid, None if gid is None else groups[gid], answers)
        return c.out

    def run(batches):
        held, size, shared = [], 0, set()
        for b in batches:
            if not b.num_rows:
                continue
            if not shared:
                shared = {b.column("h")[0].as_py()}  # the task's first stratum
            held.append(b)
            size += b.num_rows
            if size < chunk:
                continue
            table = pa.Table.from_batches(held)
            last = table.column("h")[-1].as_py()
            of_last = table.column("h").is_null() if last is None else pc.fill_null(pc.equal(table.column("h"), last), False)
            begin = size - pc.sum(of_last).as_py()
            if size - begin >= chunk or one_stratum:  # a large stratum: in pieces
                shared.add(last)
                begin = size
            if begin:
                yield from add(table.slice(0, begin), shared)
            held, size = table.slice(begin).to_batches(), size - begin
        if held:
            table = pa.Table.from_batches(held)
            yield from add(table, shared | {table.column("h")[-1].as_py()})

    return run


def cell_sums(base: DataFrame, plan: Cells, centres: dict[int, float], one_stratum: bool, with_design: bool = False,
              chunk: int = CHUNK) -> DataFrame:
    """Stored sums (``SUMS``) of ``base`` (stratum, weight, columns)."""
    ensure_checkpoint_dir(base.sparkSession)
    rows = columns(base, plan, centres)
    if not one_stratum:
        # the row number splits large strata; order and neighbours are kept when small parts are put together
        rows = (rows.withColumn("id", F.monotonically_increasing_id()).repartitionByRange("h", "id")
                .sortWithinPartitions("h").drop("id"))
    return (rows.mapInArrow(sums_of(plan, one_stratum, with_design, chunk), SUMS)
            .groupBy("part", "cid", "gval", "val", "h").agg(*[F.sum(x).alias(x) for x in NUMBERS]).checkpoint())
