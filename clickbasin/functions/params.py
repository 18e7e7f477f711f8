"""Text parameters of the jobs."""

from __future__ import annotations

# Spellings that mean "yes".
TRUE_WORDS = {"1", "true", "yes", "on"}


def flag(text: object) -> bool:
    return str(text).strip().lower() in TRUE_WORDS


def optional_number(text: str | None) -> float | None:
    """A blank threshold means the constraint is not asked for."""
    return float(text) if text and text.strip() else None


def name_list(text: str | None) -> list[str]:
    """Comma-separated names. Blank entries go; the others are not trimmed."""
    return [name for name in (text or "").split(",") if name.strip()]
