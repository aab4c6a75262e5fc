"""Cells of a list of analyses.

A cell is a (variable, group column) pair; analyses that differ in their level
alone share one. ``records`` makes the records of numeric variables for all
cells in two steps, so the plan grows with variables + cells and not with
their product: a row's answers are listed once per variable, and each answered
one is then repeated for the variable's cells.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..design import H, W
from ..functions.columns import number, q

@dataclass(frozen=True)
class Variable:
    """An analysed column: ``kind`` is the analysis type; ``choices`` are the
    (member column, choice) pairs of a select-multiple, None if its choices
    are read from the packed answers."""

    name: str
    kind: str
    choices: tuple[tuple[str, str], ...] | None = ()


@dataclass
class Cells:
    variables: list[Variable] = field(default_factory=list)
    groups: list[str] = field(default_factory=list)
    #: (variable index, group index or None) of each cell
    cells: list[tuple[int, int | None]] = field(default_factory=list)
    #: analyses of each cell
    analyses: list[list[int]] = field(default_factory=list)
    _places: dict = field(default_factory=dict)

    def _place(self, items: list, item) -> int:
        at = self._places.setdefault(id(items), {})
        if item not in at:
            at[item] = len(items)
            items.append(item)
        return at[item]

    def add(self, aid: int, variable: Variable, group: str | None) -> None:
        gid = None if group is None else self._place(self.groups, group)
        cid = self._place(self.cells, (self._place(self.variables, variable), gid))
        if cid == len(self.analyses):
            self.analyses.append([])
        self.analyses[cid].append(aid)


def at(lists: Column, index: Column) -> Column:
    """lists[index], counted from 0."""
    return F.element_at(lists, (index + 1).cast("int"))


def records(base: DataFrame, plan: Cells) -> DataFrame:
    """(stratum, weight, cid, gval, y) of every answered numeric variable and
    cell; text that is not a number, and NaN, are no answers."""
    own: list[list[int]] = [[] for _ in plan.variables]
    for cid, (vid, _) in enumerate(plan.cells):
        own[vid].append(cid)
    listed = []
    for vid, v in enumerate(plan.variables):
        y = number(F.col(q(v.name)))
        listed.append(F.when(y.isNotNull(), F.struct(F.lit(vid).alias("vid"), y.alias("y"))))
    cells_of = F.array(*[F.array(*[F.struct(F.lit(c).alias("cid"), F.lit(plan.cells[c][1]).cast("int").alias("gid"))
                                   for c in cells]) for cells in own])
    gvals = F.array(*[F.col(q(g)).cast("string") for g in plan.groups]).cast("array<string>").alias("gvals")
    # lists and records in separate operators: each stays a small compiled method
    return (base.select(H, W, gvals, F.array(*listed).alias("answers"))
            .select(H, W, "gvals", F.inline("answers")).where(F.col("vid").isNotNull())
            .select(H, W, "gvals", "y", F.inline(at(cells_of, F.col("vid"))))
            .select(H, W, "cid", at(F.col("gvals"), F.col("gid")).alias("gval"), "y"))
