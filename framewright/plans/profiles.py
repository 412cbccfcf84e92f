"""Cleaning profiles: named sets of rules, as data."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    vague: bool = True
    abstract: bool = False
    garbled: bool = True
    whole_words: bool = False
    min_words: int = 1
    max_boxes: int = 0
    dup: bool = True
    min_area: float = 0.0
    min_px: float = 0.0
    max_ratio: float = 0.0
    max_cover: float = 0.0
    edge: bool = False
    xdup: bool = False


def _phrases(**boxes) -> Profile:
    """All rules on phrases, and the given ones on boxes."""
    return Profile(abstract=True, whole_words=True, xdup=True, **boxes)


# fixed values: the thresholds of the named profiles
PROFILES = {
    "default": Profile(),
    "old": Profile(min_area=0.02, min_words=2),
    "new": Profile(min_area=0.02, whole_words=True),
    "c": _phrases(min_area=0.02),
    "base": _phrases(),
    "minpx": _phrases(min_px=48),
    "minpx32": _phrases(min_px=32),
    "ratio": _phrases(max_ratio=8.0),
    "cover": _phrases(max_cover=0.95),
    "nbox": _phrases(max_boxes=8),
    "edge": _phrases(edge=True),
    "all": _phrases(min_px=48, max_ratio=8.0, max_cover=0.95, max_boxes=8, edge=True),
    "rec": _phrases(max_cover=0.95, edge=True),
}
ABLATION = ["c", "base", "minpx", "minpx32", "ratio", "cover", "nbox", "edge", "all", "rec"]
