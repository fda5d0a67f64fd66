"""Category cleaning, flags, value mapping and numeric bands."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed sentinel texts that mean "unknown category" in the source files.
UNKNOWN_TEXTS = ("(null)", "UNKNOWN")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_known(c: Column | str, sentinels: Iterable[str] = UNKNOWN_TEXTS) -> Column:
    """True where the value is neither NULL nor a sentinel text.

    NULL rows evaluate to false (not NULL), so the predicate can be combined
    freely; it is what ``x != '(null)'`` does under three-valued logic.
    """
    c = _col(c)
    return F.coalesce(c.isNotNull() & ~c.isin(*sentinels), F.lit(False))


def yes_no_flag(c: Column | str, yes: str = "Y", no: str = "N") -> Column:
    """``Y`` → true, ``N`` → false, anything else (or NULL) → NULL."""
    c = _col(c)
    return F.when(c.cast("string") == yes, F.lit(True)).when(c.cast("string") == no, F.lit(False))


def boolean_flag(c: Column | str) -> Column:
    """Boolean from text ``true``/``false`` (any case) or a boolean; else NULL."""
    return _col(c).cast("string").try_cast("boolean")


def map_values(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Look a value up in a literal mapping; NULL where it is absent."""
    if not mapping:
        return F.lit(None).cast("string")
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(m, _col(c))


def invert_groups(groups: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    """{group: [values]} → {value: [groups]}: a value may sit in several groups."""
    out: dict[str, list[str]] = {}
    for g, values in groups.items():
        for v in values:
            if g not in out.setdefault(v, []):
                out[v].append(g)
    return out


def groups_of(c: Column | str, groups: Mapping[str, Sequence[str]]) -> Column:
    """Array of the groups a value belongs to (empty when none)."""
    inv = invert_groups(groups)
    if not inv:
        return F.array().cast("array<string>")
    m = F.create_map(*chain.from_iterable(
        (F.lit(v), F.array(*[F.lit(g) for g in gs])) for v, gs in inv.items()))
    return F.coalesce(F.try_element_at(m, _col(c)), F.array().cast("array<string>"))


@dataclass(frozen=True)
class Band:
    """A numeric band.  ``high=None`` is open above.

    Bounds are compared as given, so a value between two closed bands (for
    integer ranges, a fractional value, or the one integer excluded by a
    strict lower bound) lands in no band.
    """

    label: str
    low: float
    high: float | None = None
    low_inclusive: bool = True

    def predicate(self, c: Column) -> Column:
        lower = c >= self.low if self.low_inclusive else c > self.low
        return lower if self.high is None else lower & (c <= self.high)


# The income bands of the reference (closed integer ranges, the
# last one strictly above 123001).
INCOME_BANDS = (
    Band("Low Income", 0, 41000),
    Band("Mid Income", 41001, 72000),
    Band("Mid-High Income", 72001, 123000),
    Band("High Income", 123001, None, low_inclusive=False),
)


def band_of(c: Column | str, bands: Sequence[Band] = INCOME_BANDS) -> Column:
    """Label of the first band whose range holds the value; NULL if none."""
    c = _col(c)
    expr = None
    for b in bands:
        expr = (F.when(b.predicate(c), F.lit(b.label)) if expr is None
                else expr.when(b.predicate(c), F.lit(b.label)))
    return expr if expr is not None else F.lit(None).cast("string")


def not_sentinel_number(c: Column | str, sentinel: float = -1) -> Column:
    """True where a number is present and not the sentinel (``-1``)."""
    c = _col(c)
    return F.coalesce(c.isNotNull() & (c != sentinel), F.lit(False))
