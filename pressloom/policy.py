"""Edition policy: a small plan-time object read from the source configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

from pressloom.rules.pack import EVENT_BUDGET, MARKETS


@dataclass(frozen=True)
class Policy:
    max_age_hours: float = 72.0
    allow_carry_forward: bool = True
    render_languages: tuple[str, ...] = ()
    excluded_entry_types: tuple[str, ...] = ()
    excluded_keywords: tuple[str, ...] = ()
    required_markets: tuple[str, ...] = MARKETS
    max_items_per_market: dict[str, int] = field(default_factory=dict)
    max_media_enrichments: int = 8
    editorial_budget: dict[str, int] = field(default_factory=lambda: dict(EVENT_BUDGET))

    @classmethod
    def from_config(cls, row: dict) -> "Policy":
        """Build from the ``policy`` object of a configuration; absent fields keep the defaults."""
        known = {key: value for key, value in row.items() if value is not None and key in cls.__dataclass_fields__}
        for key in ("render_languages", "excluded_entry_types", "excluded_keywords", "required_markets"):
            if key in known:
                known[key] = tuple(known[key])
        return cls(**known)
