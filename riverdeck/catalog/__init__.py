"""Every registered query with its SQL check, gathered from the modules of this folder."""

from __future__ import annotations

from riverdeck.catalog import cards, events, hands, players, streams
from riverdeck.catalog.entry import Entry

ENTRIES: dict[str, Entry] = {}
for _module in (cards, hands, players, events, streams):
    for _entry in _module.ENTRIES:
        if _entry.name in ENTRIES:
            raise ValueError(f"query {_entry.name} registered twice")
        ENTRIES[_entry.name] = _entry
