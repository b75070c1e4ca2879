"""Column roles and categorical domains of a modelling table.

Levels are declared, never inferred from a batch, so every load encodes a
category the same way.  The first level of a categorical is its reference.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class FeatureSpec:
    target: str
    numeric: tuple[str, ...] = ()
    levels: dict[str, tuple[str, ...]] = field(default_factory=dict)
    binary: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    key: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "numeric", tuple(self.numeric))
        object.__setattr__(self, "binary", tuple(self.binary))
        object.__setattr__(self, "dates", tuple(self.dates))
        object.__setattr__(
            self, "levels", {name: tuple(domain) for name, domain in self.levels.items()}
        )
        for name, domain in self.levels.items():
            if len(set(domain)) != len(domain) or not domain:
                raise ValueError(f"levels of {name} must be non-empty and distinct")
        names = [*self.predictors, *self.dates, self.target]
        if self.key:
            names.append(self.key)
        if len(set(names)) != len(names):
            raise ValueError("a column can hold one role only")

    @property
    def categorical(self) -> tuple[str, ...]:
        return tuple(self.levels)

    @property
    def predictors(self) -> tuple[str, ...]:
        return (*self.numeric, *self.binary, *self.levels)

    def reference(self, name: str) -> str:
        return self.levels[name][0]

    def relevel(self, name: str, reference: str) -> FeatureSpec:
        """The same spec with another reference level for one categorical."""
        domain = self.levels[name]
        if reference not in domain:
            raise ValueError(f"{reference!r} is not a level of {name}")
        moved = (reference, *[lvl for lvl in domain if lvl != reference])
        return replace(self, levels={**self.levels, name: moved})

    def without(self, *names: str) -> FeatureSpec:
        """Drop predictors; names that are not there are ignored."""
        gone = set(names)
        return replace(
            self,
            numeric=tuple(c for c in self.numeric if c not in gone),
            binary=tuple(c for c in self.binary if c not in gone),
            dates=tuple(c for c in self.dates if c not in gone),
            levels={c: d for c, d in self.levels.items() if c not in gone},
        )
