"""Abnormality rules.

A rule is one Column expression over a reading and the reading before it. ``RULES`` is the
extension point: register another ``Discriminator`` and every product (annotation, points, ranges,
changes, stream) works with it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeline.functions.values import less, limit_outside, switch_ok


@dataclass(frozen=True)
class Discriminator:
    """``abnormal(reading, before)`` gets structs with ``v`` and the rule's ``params``.

    ``before.v`` is NULL for the first reading. A NULL result means *not judged*, i.e. not abnormal.
    ``shows`` maps columns of the point table to expressions over the annotated reading.
    """

    name: str
    params: tuple[str, ...]
    abnormal: Callable[[Column, Column], Column]
    shows: dict[str, str] = field(default_factory=dict)


def _limit(reading: Column, before: Column) -> Column:
    return limit_outside(reading["v"], reading["lowerbound"], reading["upperbound"])


def _switch(reading: Column, before: Column) -> Column:
    return ~switch_ok(reading["v"], reading["switch_default"])


def _cumulative(reading: Column, before: Column) -> Column:
    return less(reading["v"], before["v"])


def _amplitude(reading: Column, before: Column) -> Column:
    v, prev, amp = reading["v"], before["v"], reading["amp"].try_cast("double")
    change = F.try_divide(v - prev, prev)
    # No relative change can be told after a zero: abnormal, as long as the point has a rule.
    return F.when(prev == 0, amp.isNotNull()).otherwise(less(amp, change) | less(change, -amp))


RULES: dict[str, Discriminator] = {
    rule.name: rule
    for rule in (
        Discriminator(
            "limit",
            ("upperbound", "lowerbound"),
            _limit,
            {"upper_bound": "upperbound", "lower_bound": "lowerbound"},
        ),
        Discriminator("switch", ("switch_default",), _switch, {"switch_default": "switch_default"}),
        Discriminator("cumulative", (), _cumulative, {"previous_value": "previous_value"}),
        Discriminator("amplitude", ("amp",), _amplitude, {"previous_value": "previous_value"}),
    )
}


class _Renamed:
    def __init__(self, reading: Column, names: dict[str, str]) -> None:
        self.reading, self.names = reading, names

    def __getitem__(self, name: str) -> Column:
        return self.reading[self.names.get(name, name)]


def renamed(rule: Discriminator, names: dict[str, str]) -> Discriminator:
    """The rule over parameters that stand in other columns, such as a second version of its bounds."""
    return Discriminator(
        rule.name,
        tuple(names.get(p, p) for p in rule.params),
        lambda reading, before: rule.abnormal(_Renamed(reading, names), _Renamed(before, names)),
        {shown: names.get(source, source) for shown, source in rule.shows.items()},
    )
