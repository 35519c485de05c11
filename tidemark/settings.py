"""Settings, passed explicitly to every operator that needs them."""

from __future__ import annotations

from dataclasses import dataclass, fields


@dataclass(frozen=True)
class DiffusionSettings:
    """How a leading and a following segment are compared.

    Thresholds are inclusive. `year_from` and `year_to` bound the year-over-year change; `window` is
    the number of months on either side of the lead trend.
    """

    lead: str = "GLOBAL"
    follow: str = "KE"
    lead_share_min: float = 0.05
    follow_share_max: float = 0.02
    trend_min: float = 0.01
    gap_floor: float = -0.01
    min_cell: int = 100
    min_history_months: int = 12
    window: int = 6
    min_baselines: int = 3
    #: A lag estimated from thin years would be invented, so it stays null; the switch only says whether one is asked for.
    enable_lag_estimate: bool = False
    year_from: int = 2024
    year_to: int = 2025
    #: Skills of which both segments are taken to ask alike; their median gap calibrates all others.
    baselines: tuple[str, ...] = ("SQL", "Git", "Java", "HTML", "CSS", "Linux", "Excel")

    @classmethod
    def from_mapping(cls, given: dict) -> DiffusionSettings:
        """Settings by their names, as read from a file; what isn't given keeps its default, unknown names are an error."""
        types = {f.name: type(f.default) for f in fields(cls)}
        if unknown := sorted(set(given) - set(types)):
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        return cls(**{name: types[name](value) for name, value in given.items()})


#: Sources whose postings keep their original dates; `wayback` stands for all replayed sources.
HISTORY_SOURCES = ("threadwork", "wayback")
