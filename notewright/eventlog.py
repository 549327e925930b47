"""A driver-side event log: JSON lines with a context that events inherit."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from typing import TextIO


class EventLog:
    """Writes an event per line: timestamp (UTC, Z), level, logger, message, then context and own fields."""

    def __init__(self, out: TextIO, name: str = "notewright"):
        self.out, self.name, self.context = out, name, {}

    def set_context(self, **fields) -> None:
        self.context |= fields

    @contextmanager
    def within(self, **fields) -> Iterator[EventLog]:
        """Fields that hold inside the block only."""
        before, self.context = self.context, self.context | fields
        try:
            yield self
        finally:
            self.context = before

    def log(self, level: str, message: str, **fields) -> None:
        head = {"timestamp": datetime.now(timezone.utc).isoformat().replace("+00:00", "Z"), "level": level, "logger": self.name, "message": message}
        self.out.write(json.dumps(head | {**self.context, **fields}, ensure_ascii=False, default=str) + "\n")

    def metric(self, name: str, value: float, **fields) -> None:
        self.log("INFO", f"metric {name}", metric=name, value=value, **fields)

    def event(self, name: str, **fields) -> None:
        """A typed event: config, epoch_start, epoch_end, training_start, training_end."""
        self.log("INFO", name, event=name, **fields)
