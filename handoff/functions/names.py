"""Name similarity on column names (metadata only, runs on the driver over a few names)."""

from __future__ import annotations

import difflib
from collections.abc import Sequence

from handoff.config import NAME_SIMILARITY_CUTOFF


def closest_name(name: str, candidates: Sequence[str], cutoff: float = NAME_SIMILARITY_CUTOFF) -> str | None:
    """Most similar candidate by difflib's ratio, or None below the cutoff."""
    hits = difflib.get_close_matches(name, list(candidates), n=1, cutoff=cutoff)
    return hits[0] if hits else None
