"""A log file whose lines bear the time of a zone's clock, whatever the machine's own."""

from __future__ import annotations

import logging
from datetime import datetime
from pathlib import Path
from zoneinfo import ZoneInfo


class ZoneFormatter(logging.Formatter):
    """Lines of time, level and message."""

    def __init__(self, zone: str = "Europe/Paris") -> None:
        super().__init__("%(asctime)s - %(levelname)s - %(message)s")
        self.zone = ZoneInfo(zone)

    def formatTime(self, record: logging.LogRecord, datefmt: str | None = None) -> str:  # noqa: N802  the library's name
        there = datetime.fromtimestamp(record.created, self.zone)
        return there.strftime(datefmt) if datefmt else there.isoformat(" ", "seconds")


def logger_to(path: str, name: str = "granary", zone: str = "Europe/Paris") -> logging.Logger:
    """A logger of the driver that writes to path alone; asked for again, it goes on with the new path."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    out = logging.getLogger(name)
    for handler in list(out.handlers):
        out.removeHandler(handler)
        handler.close()
    handler = logging.FileHandler(path, encoding="utf-8")
    handler.setFormatter(ZoneFormatter(zone))
    out.addHandler(handler)
    out.setLevel(logging.INFO)
    out.propagate = False
    return out
