"""Times and groups that several tests use."""

from __future__ import annotations

from datetime import datetime, timedelta

EPOCH = datetime(1970, 1, 1)


def at(ms: int) -> datetime:
    return EPOCH + timedelta(milliseconds=ms)


def by_key(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    return groups
