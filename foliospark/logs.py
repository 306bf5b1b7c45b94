"""Logging for a driver: plain lines or JSON."""

from __future__ import annotations

import json
import logging


class _Json(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        out = {"time": self.formatTime(record), "level": record.levelname.lower(), "logger": record.name, "event": record.getMessage()}
        if record.exc_info:
            out["exception"] = self.formatException(record.exc_info)
        return json.dumps(out, ensure_ascii=False)


def setup_logging(level: str = "INFO", json_output: bool = False) -> None:
    """Set the root logger's level and form; noisy libraries stay at warnings."""
    handler = logging.StreamHandler()
    handler.setFormatter(_Json() if json_output else logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
    root = logging.getLogger()
    root.handlers[:] = [handler]
    root.setLevel(level.upper())
    for name in ("py4j", "urllib3"):
        logging.getLogger(name).setLevel(logging.WARNING)
