"""Cuboids of the quality cube (A8 with V17-V19): which roll-ups to land, and which one a view reads.

A view needs the dimensions that it groups by or filters on; any landed roll-up that has them all can answer it, the smallest
one fastest.  Given the views to be served and a budget of cells, roll-ups are chosen greedily by the cells
they spare the views (each view costs the size of the smallest table that covers it), one after another, until nothing more
fits or helps.  Sizes are estimated in one pass over the cube.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanscope.functions.scalars import exact_sum
from loanscope.operators.filters import QUALITY_DIMS, Filters

Dims = frozenset[str]
MEASURES = ("c", "s", "r", "rc")


def columns_of(dims: Iterable[str]) -> list[str]:
    """Cube columns of dimensions, in the cube's order."""
    chosen = set(dims)
    return [c for d, c in QUALITY_DIMS.items() if d in chosen]


def active(f: Filters, ignore: Iterable[str] = ()) -> set[str]:
    return {d for d in QUALITY_DIMS if d not in set(ignore) and getattr(f, d) is not None}


def needs(f: Filters, group_by: Iterable[str] = (), ignore: Iterable[str] = ()) -> Dims:
    """The dimensions that a view under ``f`` reads."""
    return frozenset(active(f, ignore) | set(group_by))


def quality_view_needs(f: Filters, panels: Sequence[str]) -> list[Dims]:
    """V17, each of V18 and V19 under ``f``."""
    return [needs(f), *[needs(f, ("year", d), ("year", d)) for d in panels], needs(f, panels)]


def sizes(cube: DataFrame, candidates: Iterable[Dims]) -> dict[Dims, int]:
    """About how many cells each roll-up has, in one pass (HyperLogLog++); no dimension: one cell."""
    some = sorted({c for c in candidates if c}, key=sorted)
    if not some:
        return {frozenset(): 1}
    counts = cube.agg(*[F.approx_count_distinct(F.xxhash64(*columns_of(c)), 0.02).alias(f"n{i}") for i, c in enumerate(some)]).first()
    return {frozenset(): 1} | {c: counts[i] for i, c in enumerate(some)}


def choose(size: Mapping[Dims, int], views: Sequence[Dims], whole: int, budget: int) -> list[Dims]:
    """Roll-ups to land: at each step the one that spares the views the most cells per cell of its own; ties by size, then by name.

    ``whole`` is the size of the cube itself, which covers every view.
    """
    cost = [whole] * len(views)
    chosen: list[Dims] = []
    left = budget
    while True:
        best = None
        for dims, n in size.items():
            if dims in chosen or n > left:
                continue
            spared = sum(max(0, c - n) for c, v in zip(cost, views) if v <= dims)
            rank = (-spared / max(1, n), n, sorted(dims))
            if spared > 0 and (best is None or rank < best[0]):
                best = rank, dims, n
        if best is None:
            return chosen
        _, dims, n = best
        chosen.append(dims)
        left -= n
        cost = [min(c, n) if v <= dims else c for c, v in zip(cost, views)]


def unions(views: Sequence[Dims], most: int = 32) -> list[Dims]:
    """Candidates: the views' own dimensions and unions of two, the narrowest first."""
    own = sorted(set(views), key=lambda v: (len(v), sorted(v)))
    pairs = sorted({a | b for i, a in enumerate(own) for b in own[:i]} - set(own), key=lambda v: (len(v), sorted(v)))
    return [*own, *pairs][:max(most, len(own))]


def rolled_up(cube: DataFrame, dims: Dims) -> DataFrame:
    """The cube by ``dims`` alone."""
    return cube.groupBy(*columns_of(dims)).agg(*[exact_sum(m).alias(m) if m in ("s", "r") else F.sum(m).cast("bigint").alias(m) for m in MEASURES])


@dataclass
class Cuboids:
    """The cube and its landed roll-ups, with their sizes."""
    cube: DataFrame
    whole: int
    tables: dict[Dims, DataFrame] = field(default_factory=dict)
    size: dict[Dims, int] = field(default_factory=dict)

    def covering(self, dims: Dims) -> DataFrame:
        """The smallest table that has ``dims``; ties by name."""
        fits = [d for d in self.tables if dims <= d]
        best = min(fits, key=lambda d: (self.size[d], sorted(d)), default=None)
        return self.cube if best is None or self.size[best] >= self.whole else self.tables[best]


def build(wh, views: Sequence[Dims], budget: int, name: str = "quality") -> Cuboids:
    """Choose and land roll-ups of the warehouse's ``name`` cube for ``views``; chosen and written once."""
    return wh.remembered(("cuboids", name, tuple(views), budget), lambda: _build(wh, views, budget, name))


def _build(wh, views: Sequence[Dims], budget: int, name: str) -> Cuboids:
    cube = wh.table(name)
    whole = cube.count()
    size = sizes(cube, unions(views))
    chosen = choose(size, views, whole, budget)
    tables = {d: wh.derived(f"{name}-by-{'-'.join(columns_of(d)) or 'nothing'}", lambda d=d: rolled_up(cube, d)) for d in chosen}
    return Cuboids(cube, whole, tables, {d: size[d] for d in chosen})
