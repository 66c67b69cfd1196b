"""What to compare and how to block."""

from __future__ import annotations

from dataclasses import dataclass

EXACT, DATE, TEXT = "exact", "date", "text"


@dataclass(frozen=True)
class Comparison:
    """One comparison column. Levels are numbered 0 (disagree) up to ``top`` (exact); null on a side is -1."""

    column: str
    kind: str = EXACT
    thresholds: tuple[float, ...] = ()
    term_frequency: bool = False

    @property
    def labels(self) -> tuple[str, ...]:
        """Level labels from 0 up."""
        if self.kind == EXACT:
            return ("else", "exact")
        if self.kind == DATE:
            return ("else", "within 2 years", "within 1 month", "one edit", "exact")
        return ("else", *[f"similarity >= {t}" for t in sorted(self.thresholds)], "exact")

    @property
    def top(self) -> int:
        return len(self.labels) - 1


@dataclass(frozen=True)
class LinkSettings:
    id_column: str
    rules: tuple[tuple[str, ...], ...]
    comparisons: tuple[Comparison, ...]

    def __post_init__(self):
        names = {c.column for c in self.comparisons}
        for rule in self.rules:
            if not rule or not set(rule) <= names:
                raise ValueError(f"rule {rule} uses columns that are not compared")

    @property
    def columns(self) -> list[str]:
        return [c.column for c in self.comparisons]

    def comparison(self, column: str) -> Comparison:
        return next(c for c in self.comparisons if c.column == column)


# The four blocking rules and seven comparisons of the identity model.
DEFAULT_SETTINGS = LinkSettings(
    id_column="record_id",
    rules=(
        ("national_id",),
        ("clean_name", "birth_date"),
        ("clean_mother", "birth_date"),
        ("clean_name", "gender", "clean_mother"),
    ),
    comparisons=(
        Comparison("national_id"),
        Comparison("birth_date", DATE),
        Comparison("gender"),
        Comparison("clean_name", TEXT, (0.97, 0.93, 0.88), term_frequency=True),
        Comparison("clean_address", TEXT, (0.95, 0.90, 0.85)),
        Comparison("clean_father", TEXT, (0.97, 0.93, 0.88), term_frequency=True),
        Comparison("clean_mother", TEXT, (0.97, 0.93, 0.88), term_frequency=True),
    ),
)
