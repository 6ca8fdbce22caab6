"""Exact quantiles of whole columns, several at once, without shuffling their values.

A built-in mergeable sketch gives two values that enclose a wanted rank; one
more aggregate counts the rows below, on and between them. These counts are
exact, so they prove the enclosure, or tell in which part beside it the rank
lies. Either the rank falls on one of the two values, or the search goes on
between them, where few rows are left: a few ten-thousandths of those before.
Both steps are aggregates of one row, whatever the table's size and however
often a value repeats; all columns share them. Once at most ``FEW`` values of a
column are left, these alone are grouped and ranked.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000
#: How far, in shares of the rows, the two values are set from the rank; twice the sketch's error.
_SLACK = 2.0 / ACCURACY
FEW = 4096


@dataclass(frozen=True)
class _Search:
    """A rank of a column, known to lie strictly between two values; None is no bound."""

    column: str
    rank: int
    low: float | None
    high: float | None
    #: Rows up to and with ``low``, and rows between.
    before: int
    between: int

    def inside(self, value: Column) -> Column:
        found = ~F.isnan(value)
        if self.low is not None:
            found &= value > F.lit(self.low)
        if self.high is not None:
            found &= value < F.lit(self.high)
        return found

    def span(self) -> tuple[str, float | None, float | None]:
        return self.column, self.low, self.high

    def share(self) -> float:
        return (self.rank - self.before) / max(self.between - 1, 1)


def _enclosed(values: DataFrame, open_: list[_Search]) -> list[tuple[float, float]]:
    """Two values about the rank of each search, from sketches of the rows between its bounds.

    Neighbouring ranks between the same bounds share a sketch and its two values.
    """
    shares: dict[tuple, list[float]] = {}
    for s in open_:
        shares.setdefault(s.span(), []).append(s.share())
    search = {s.span(): s for s in open_}
    sketches = []
    for span, at in shares.items():
        value = F.col(span[0])
        about = [max(min(at) - _SLACK, 0.0), min(max(at) + _SLACK, 1.0)]
        sketches.append(F.percentile_approx(F.when(search[span].inside(value), value), about, ACCURACY))
    found = dict(zip(shares, values.agg(*[x.alias(f"s{i}") for i, x in enumerate(sketches)]).first(), strict=True))
    return [tuple(found[s.span()]) for s in open_]


def _narrowed(values: DataFrame, open_: list[_Search], ends: list[tuple[float, float]]) -> list[_Search | float]:
    """Each search's value, or the search between closer bounds."""
    parts: dict[tuple, tuple[Column, ...]] = {}
    for s, (a, b) in zip(open_, ends, strict=True):
        v, a_, b_ = F.col(s.column), F.lit(a), F.lit(b)
        inside = s.inside(v)
        parts[s.span(), a, b] = (inside & (v < a_), v == a_, inside & (v > a_) & (v < b_), (v == b_) & (b_ > a_))
    row = values.agg(*[F.count_if(c).alias(f"c{i}_{j}") for i, four in enumerate(parts.values()) for j, c in enumerate(four)]).first()
    places = {key: 4 * i for i, key in enumerate(parts)}
    out: list[_Search | float] = []
    for s, (a, b) in zip(open_, ends, strict=True):
        at = places[s.span(), a, b]
        below, on_a, amid, on_b = row[at : at + 4]
        at = s.rank - s.before
        if at < below:
            out.append(_Search(s.column, s.rank, s.low, a, s.before, below))
        elif at < below + on_a:
            out.append(a)
        elif at < below + on_a + amid:
            out.append(_Search(s.column, s.rank, a, b, s.before + below + on_a, amid))
        elif at < below + on_a + amid + on_b:
            out.append(b)
        else:
            done = below + on_a + amid + on_b
            out.append(_Search(s.column, s.rank, b, s.high, s.before + done, s.between - done))
    return out


def _ranked(values: DataFrame, few: list[_Search]) -> dict[_Search, float]:
    """The values of searches with few rows left; only these rows are grouped."""
    parts = {s.span(): s for s in few}
    names = list(parts)
    pairs = [F.struct(F.lit(i).alias("part"), F.when(parts[n].inside(F.col(n[0])), F.col(n[0])).alias("v")) for i, n in enumerate(names)]
    left = values.select(F.inline(F.filter(F.array(*pairs), lambda x: x["v"].isNotNull())))
    counted = left.groupBy("part", "v").agg(F.count(F.lit(1)).alias("n"))
    # At most FEW rows a part.
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("v"))
    spans = counted.select("part", "v", (upto - F.col("n")).alias("first"), upto.alias("end"))
    wanted = [(names.index(s.span()), s.rank - s.before) for s in few]
    hit = F.lit(False)
    for part, at in sorted(set(wanted)):
        hit |= (F.col("part") == part) & (F.col("first") <= at) & (F.col("end") > at)
    rows = spans.where(hit).collect()
    return {s: next(r.v for r in rows if r.part == part and r.first <= at < r.end) for s, (part, at) in zip(few, wanted, strict=True)}


def whole_quantiles(df: DataFrame, wanted: dict[str, tuple[str | Column, float, str]]) -> dict[str, float | None]:
    """Quantiles by name: each of a column, a share, and ``interpolated`` or ``nearest``.

    ``interpolated`` is the SQL ``percentile_cont``; ``nearest`` takes the value
    whose 0-based rank is ``p * (n - 1)`` rounded half to even. Nulls are left
    out; NaN is greater than all numbers; None where a column has no value.
    ``df`` is read a few times at once: pass a stored table.
    """
    for _, p, method in wanted.values():
        if method not in ("interpolated", "nearest"):
            raise ValueError(f"unknown method: {method}")
        if not 0.0 <= p <= 1.0:
            raise ValueError("p must lie in [0, 1]")
    if not wanted:
        return {}
    names = {name: f"q{i}" for i, name in enumerate(wanted)}
    values = df.select(*[(F.col(c) if isinstance(c, str) else c).cast("double").alias(names[name]) for name, (c, _, _) in wanted.items()])
    sizes = values.agg(*[F.count(c).alias(f"n_{c}") for c in names.values()], *[F.count_if(F.isnan(c)).alias(f"x_{c}") for c in names.values()]).first()

    ranks: dict[str, tuple[float, list[int]]] = {}
    known: dict[tuple[str, int], float] = {}
    todo: list[_Search] = []
    for name, (_, p, method) in wanted.items():
        column, n = names[name], sizes[f"n_{names[name]}"]
        numbers = n - sizes[f"x_{column}"]
        position = p * (n - 1)
        both = [min(round(position), n - 1)] if method == "nearest" else [math.floor(position), math.ceil(position)]
        ranks[name] = position, both if n else []
        for rank in dict.fromkeys(ranks[name][1]):
            if rank >= numbers:
                known[column, rank] = math.nan
            else:
                todo.append(_Search(column, rank, None, None, 0, numbers))
    while many := [s for s in todo if s.between > FEW]:
        todo = [s for s in todo if s.between <= FEW]
        for s, found in zip(many, _narrowed(values, many, _enclosed(values, many)), strict=True):
            if isinstance(found, _Search):
                todo.append(found)
            else:
                known[s.column, s.rank] = found
    if todo:
        known |= {(s.column, s.rank): v for s, v in _ranked(values, todo).items()}

    out: dict[str, float | None] = {}
    for name, (position, both) in ranks.items():
        ends = [known[names[name], rank] for rank in both]
        if not ends:
            out[name] = None
        elif ends[0] == ends[-1] or wanted[name][2] == "nearest":
            out[name] = ends[0]  # equal ends need no arithmetic, which would turn infinity into NaN
        else:
            out[name] = ends[0] + (ends[1] - ends[0]) * (position - math.floor(position))
    return out
