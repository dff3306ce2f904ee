"""What a panel is made of, by column names, so that the same operators serve any table."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class PanelSpec:
    """Key, hierarchy and measures of a panel.

    ``vintage`` names the cross-section, ``unit`` the leaf; ``hierarchy`` the levels above the leaf, outermost first,
    as (id column, label column). Measures lie within ``bounds`` or are null.
    """

    vintage: str = "year"
    unit: str = "unit"
    hierarchy: tuple[tuple[str, str], ...] = ()
    measures: tuple[str, ...] = ()
    bounds: tuple[float, float] = (0.0, 100.0)
    labels: tuple[str, ...] = field(default=())

    @property
    def key(self) -> list[str]:
        return [self.vintage, self.unit]

    @property
    def level_ids(self) -> list[str]:
        return [i for i, _ in self.hierarchy]

    @property
    def level_labels(self) -> list[str]:
        return [label for _, label in self.hierarchy]
