"""Column roles passed to operators (never stored in the data)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Roles:
    """Which column plays which part.

    ``id_col`` is mandatory for every keyed operator: Spark has no stable
    row order, so positional alignment of the reference becomes a join on
    this key.
    """

    id_col: str = "id"
    class_col: str | None = None
    price_col: str | None = None
    categorical: tuple[str, ...] = field(default_factory=tuple)
    ordinal: tuple[str, ...] = field(default_factory=tuple)
    numeric: tuple[str, ...] = field(default_factory=tuple)
    binary: tuple[str, ...] = field(default_factory=tuple)
    text: tuple[str, ...] = field(default_factory=tuple)

    @property
    def labels(self) -> tuple[str, ...]:
        return tuple(c for c in (self.class_col, self.price_col) if c)

    @property
    def features(self) -> tuple[str, ...]:
        return self.categorical + self.binary + self.ordinal + self.numeric
