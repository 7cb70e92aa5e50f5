"""Argument checks: limits are clamped, everything else out of range is refused."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

from entitylake import constants as K


def clamp_limit(limit: float | None) -> int | None:
    """Unset stays unset; otherwise a whole number from 1 to the page maximum."""
    if limit is None:
        return None
    if not math.isfinite(limit) or limit < 1:
        return 1
    return min(math.floor(limit), K.MAX_SEARCH_LIMIT)


def clean_offset(offset: float | None) -> int:
    """A whole number from 0 up; values that are not finite count as 0."""
    if offset is None or not math.isfinite(offset):
        return 0
    return max(0, math.floor(offset))


def top_hits(count: int | None) -> int:
    if count is None or count < 0:
        return K.DEFAULT_TOP_HITS
    return min(count, K.MAX_TOP_HITS)


def within(name: str, value: int, low: int, high: int) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or not low <= value <= high:
        raise ValueError(f"{name} must be a whole number from {low} to {high}, got {value!r}")
    return value


def required_id(entity_id: str) -> str:
    cleaned = entity_id.strip(K.WHITESPACE)
    if not cleaned:
        raise ValueError("an entity id is required")
    return cleaned


def schema_names(value: str | Iterable[str] | None) -> list[str]:
    """Names from ``"A,B"``, ``"A B"`` or a list: in order, without repeats."""
    if value is None:
        return []
    items = [value] if isinstance(value, str) else list(value)
    names: dict[str, None] = {}
    for item in items:
        if isinstance(item, str):
            names.update(dict.fromkeys(part for part in re.split(r"[,\s]+", item) if part))
    return list(names)
