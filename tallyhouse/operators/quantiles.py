"""Exact quantiles without sorting a column or holding it in one task.

Each wanted rank is narrowed to a range of values: a sketch names a range that should hold it, a
counted pass says how many rows lie below and inside, and the next pass looks at that range alone.
A range of one value is an answer, however many rows share it; a range of few rows is fetched. A
pass cuts the rows by about the accuracy of the sketch, so three passes do for nearly any table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ACCURACY = 2000
_FETCHED = 1000  # rows of one range that may reach the driver


@dataclass
class _Wanted:
    """A rank of a column (from 0) among its sorted values, and the range that holds it."""

    column: str
    rank: int
    below: int  # values under ``low``
    inside: int  # values from ``low`` to ``high``
    low: float = -math.inf
    high: float = math.inf

    def found(self) -> bool:
        return self.low == self.high

    def rows(self):
        value = F.col(self.column)
        return F.when(value.between(F.lit(self.low), F.lit(self.high)), value)


def _narrowed(df: DataFrame, wanted: list[_Wanted]) -> None:
    """One sketch and one count over each range. The ends of the sketched range are counted apart, so a
    range always loses them or becomes one of them."""
    sketches = []
    for i, w in enumerate(wanted):
        at, slack = (w.rank - w.below + 0.5) / w.inside, 1.5 / _ACCURACY + 1 / w.inside
        edges = [max(at - slack, 0.0), min(at + slack, 1.0)]
        sketches.append(F.percentile_approx(w.rows(), edges, _ACCURACY).alias(f"r{i}"))
    ranges = df.agg(*sketches).first()
    counts = []
    for i, w in enumerate(wanted):
        low, high = (F.lit(edge) for edge in ranges[i])
        value = w.rows()
        parts = [value < low, value == low, (value > low) & (value < high), (value == high) & (value > low)]
        counts.append(F.array(*[F.count_if(part) for part in parts]).alias(f"n{i}"))
    numbers = df.agg(*counts).first()
    for w, (low, high), (under, at_low, inside, at_high) in zip(wanted, ranges, numbers):
        pieces = [
            (w.low, _before(low), under), (low, low, at_low), (_after(low), _before(high), inside), (high, high, at_high),
            (_after(high), w.high, w.inside - under - at_low - inside - at_high),
        ]
        for w.low, w.high, w.inside in pieces:
            if w.rank < w.below + w.inside:
                break
            w.below += w.inside


def _before(value: float) -> float:
    return math.nextafter(value, -math.inf)


def _after(value: float) -> float:
    return math.nextafter(value, math.inf)


def exact_quantiles(df: DataFrame, columns: list[str], shares: list[float]) -> dict[str, list[float | None]]:
    """For each column the quantiles at the given shares, linear between the two values around.

    NULL and NaN are left out; a column without values has None. All columns and shares go through
    the same passes.
    """
    numbers = [F.col(c).cast("double") for c in columns]
    values = df.select(*[F.when(~F.isnan(n), n).alias(f"c{i}") for i, n in enumerate(numbers)])
    names = dict(zip(columns, values.columns))
    if not columns:
        return {}
    counts = dict(zip(columns, values.agg(*[F.count(n) for n in values.columns]).first()))
    wanted: dict[tuple[str, int], _Wanted] = {}
    for c, n in counts.items():
        for share in shares if n else []:
            at = share * (n - 1)
            for rank in {math.floor(at), math.ceil(at)}:
                wanted[c, rank] = _Wanted(names[c], rank, 0, n)
    while True:
        wide = [w for w in wanted.values() if not w.found() and w.inside > _FETCHED]
        if not wide:
            break
        _narrowed(values, wide)
    few = [w for w in wanted.values() if not w.found()]
    if few:
        lists = values.agg(*[F.sort_array(F.collect_list(w.rows())).alias(f"v{i}") for i, w in enumerate(few)]).first()
        for w, held in zip(few, lists):
            w.low = w.high = held[w.rank - w.below]

    def between(c: str, share: float) -> float | None:
        if not counts[c]:
            return None
        at = share * (counts[c] - 1)
        low, high = wanted[c, math.floor(at)].low, wanted[c, math.ceil(at)].low
        return low + (high - low) * (at - math.floor(at)) if low != high else low

    return {c: [between(c, s) for s in shares] for c in columns}
