"""Parameters of the operators. The reference's four pipeline variants differ
only in these values; presets reproduce each of them."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class CohortSpec:
    """A named half-open date range [start, end); ``None`` leaves a side open."""

    name: str
    start: date | None = None
    end: date | None = None


@dataclass(frozen=True)
class CohortFilter:
    """Optional filters shared by all cohorts; ``None`` (or "all selected") = no filter."""

    dow: tuple[int, ...] | None = None  # Sunday = 0
    tod: tuple[int, ...] | None = None  # hour buckets 4..24
    boro: tuple[int, ...] | None = None
    sta: tuple[str, ...] | None = None

    def active(self) -> dict[str, tuple]:
        """The filters that restrict: set, and not all of their values ticked (see ``OPTIONS``)."""
        given = {"dow": self.dow, "tod": self.tod, "boro": self.boro, "sta": self.sta}
        return {k: tuple(v) for k, v in given.items() if v and not len(set(v)) >= OPTIONS.get(k, len(set(v)) + 1)}


#: How many values each filter offers; all of them ticked is no filter. Stations have no such number.
OPTIONS: dict[str, int] = {"dow": 7, "tod": 6, "boro": 5}


@dataclass(frozen=True)
class StagingRules:
    """Staging of raw readings (canonical = dbt model)."""

    start_date: date = date(2019, 1, 1)
    drop_audit: bool = False
    audit_label: str = "RECOVR AUD"
    exclude_divisions: tuple[str, ...] = ("SRT",)
    exclude_stations: tuple[str, ...] = ()


@dataclass(frozen=True)
class DiffPolicy:
    """How counter differences are formed and which are kept.

    negative: 'abs' (|diff|), 'drop' (delete the row, NULL survives), 'zero'.
    first:    'drop' (first reading of a series has no diff) or 'zero'.
    cap_rule: 'keep_below' (keep x < cap), 'keep_at_most' (delete x > cap),
              'zero_above' (set x > cap to 0).
    """

    negative: str = "abs"
    first: str = "drop"
    max_gap_s: int | None = 345600
    seconds_per_count: float | None = 2.0
    entry_cap: int | None = 7200
    exit_cap: int | None = 7200
    cap_rule: str = "keep_below"


DBT_DIFF = DiffPolicy()
V1_DIFF = DiffPolicy(negative="drop", max_gap_s=None, seconds_per_count=None, cap_rule="keep_at_most")
PANDAS_DIFF = DiffPolicy(
    negative="zero", first="zero", max_gap_s=None, seconds_per_count=None,
    entry_cap=2880, exit_cap=7200, cap_rule="zero_above",
)


@dataclass(frozen=True)
class CutoffRule:
    """Per-series anomaly cutoff: mean + k * sd of the positive differences,
    replaced by ``floor`` when n <= min_n, undefined, below ``floor`` or above
    ``ceiling``."""

    k: float = 4.0
    floor: float = 2000.0
    min_n: int = 20
    ceiling: float | None = None


DBT_CUTOFF = CutoffRule(k=4.0)
V1_CUTOFF = CutoffRule(k=3.0)
NOTEBOOK_CUTOFF = CutoffRule(k=3.0, ceiling=100000.0)


@dataclass(frozen=True)
class BoroughRules:
    """Station-list borough coding: description rewrites, then label -> code."""

    cbd_label: str = "Manhattan below 63 St"
    split_desc: str = "Manhattan"
    above_label: str = "Manhattan above 63 St"
    codes: dict[str, int] = field(
        default_factory=lambda: {
            "Manhattan below 63 St": 1,
            "Manhattan above 63 St": 2,
            "Brooklyn": 3,
            "Queens": 4,
            "Bronx": 5,
        }
    )
    unmapped_code: int = -1
