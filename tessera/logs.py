"""Logs of a stage: JSON lines and text side by side, on the driver."""

from __future__ import annotations

import json
import logging
from datetime import datetime
from pathlib import Path


class _Json(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        return json.dumps({"time": self.formatTime(record), "level": record.levelname, "logger": record.name, "event": record.getMessage(), **getattr(record, "fields", {})}, ensure_ascii=False)


def stage_logger(stage: str, folder: str) -> logging.Logger:
    """A logger that writes ``<stage>_<stamp>.json`` and ``.log`` below ``folder``."""
    logger = logging.getLogger(f"tessera.{stage}")
    logger.setLevel(logging.INFO)
    for h in list(logger.handlers):
        logger.removeHandler(h)
    root = Path(folder)
    root.mkdir(parents=True, exist_ok=True)
    stamp = datetime.now().strftime("%Y%m%d_%H%M%S")
    for ext, fmt in (("json", _Json()), ("log", logging.Formatter("%(asctime)s %(levelname)s %(message)s"))):
        handler = logging.FileHandler(root / f"{stage}_{stamp}.{ext}", encoding="utf-8")
        handler.setFormatter(fmt)
        logger.addHandler(handler)
    return logger
