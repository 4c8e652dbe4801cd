"""What one interactive question selects."""

from __future__ import annotations

from dataclasses import dataclass, replace

from municipia.fixed_values import ALL

CROP_METRICS = ("a", "p", "v", "r")
LIVESTOCK_METRICS = ("q", "v")


@dataclass(frozen=True)
class Selection:
    """Parameters of one query.

    ``compat=True`` reproduces the known quirks of the published dashboard: yields are added up over
    categories and states, yield reads 0 below state level, and a chosen category is ignored below
    state level unless it is combine-harvested. The default computes the true value.
    """

    domain: str = "crop"  # crop | livestock
    metric: str = "p"  # crop: a, p, v, r; livestock: q, v
    group: str = ALL  # ALL, TEM, PER, COL, TRA
    category: str | None = None
    kind: str = "Rebanho"  # livestock: Rebanho | Producao
    uf: str | None = None
    mic: str | None = None
    mun: object | None = None
    year: int | None = None
    compat: bool = False

    def __post_init__(self) -> None:
        if self.domain not in ("crop", "livestock"):
            raise ValueError(f"unknown domain {self.domain!r}")
        allowed = CROP_METRICS if self.domain == "crop" else LIVESTOCK_METRICS
        if self.metric not in allowed:
            raise ValueError(f"metric {self.metric!r} is not one of {allowed} for {self.domain}")

    def with_(self, **changes: object) -> Selection:
        return replace(self, **changes)

    def scope_level(self) -> str:
        """Series scope by precedence: micro-region, then state, then the whole country."""
        return "mic" if self.mic is not None else "uf" if self.uf is not None else "country"

    def micro_group_key(self, combine_categories: list[str]) -> str:
        """Group key read below state level: the category if combine-harvested, else its group."""
        return self.category if self.category in combine_categories else self.group
