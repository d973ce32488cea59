"""Tiered compaction (SNK-4, PUB-1): when the folders of a table are merged.

A record lists a table's folders in commit order. A fresh one is of tier 0;
once ``FANOUT`` of one tier stand at the end of the list they are merged into
one of the next tier. So a row is rewritten once per tier, a logarithmic number
of times, and a list holds at most ``FANOUT - 1`` folders of each tier. Only
neighbours are merged, so an entry still covers a range of batches or runs.
"""

from __future__ import annotations

FANOUT = 8


def tier(entry: dict) -> int:
    return entry.get("tier", 0)


def due(entries: list[dict], fanout: int = FANOUT) -> tuple[int, int] | None:
    """(first entry to merge, tier of the result), or None. What a merge makes
    counts for the next tier at once, so no row is written twice in one go."""
    start, made = len(entries), None
    while True:
        level, at = made or 0, start
        while at and tier(entries[at - 1]) <= level:
            at -= 1
        of_level = sum(tier(e) == level for e in entries[at:start]) + (made is not None)
        if of_level < fanout:
            return None if made is None else (start, made)
        start, made = at, level + 1


def merged_entry(old: list[dict], path: str, level: int) -> dict:
    """The entry of a folder that holds the rows of ``old``."""
    return {"path": path, "id": old[-1]["id"], "first": old[0].get("first", old[0]["id"]),
            "rows": sum(e["rows"] for e in old), "tier": level}


def put(entries: list[dict], old: list[dict], new: dict) -> list[dict] | None:
    """``entries`` with ``new`` in the place of ``old``; None if they no longer
    hold exactly these (another writer has merged some of them)."""
    paths = [e["path"] for e in entries]
    if old[0]["path"] not in paths:
        return None
    at = paths.index(old[0]["path"])
    if paths[at : at + len(old)] != [e["path"] for e in old]:
        return None
    return [*entries[:at], new, *entries[at + len(old) :]]
