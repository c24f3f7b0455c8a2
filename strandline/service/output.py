"""Where results go: standard output or a new file below a folder; log lines; redaction."""

from __future__ import annotations

import json
import logging
import os
import re
import sys
from datetime import datetime, timezone
from pathlib import Path


class OutputError(ValueError):
    """The output file may not be written."""


def emit(text: str, target: str | None = None, base: str | None = None) -> None:
    """Write to standard output, or to a file that does not exist yet below ``base`` (the working directory).

    No link is followed on the way, so a result cannot land outside.
    """
    if target is None:
        sys.stdout.write(text if text.endswith("\n") else text + "\n")
        return
    root = Path(base or os.getcwd()).resolve()
    path = Path(target)
    if path.is_absolute() or ".." in path.parts or not path.parts:
        raise OutputError("the output file must lie below the working directory")
    folder = (root / path).parent
    if folder.resolve() != folder or not folder.is_dir():
        raise OutputError("the output folder is missing or reached through a link")
    try:
        fd = os.open(root / path, os.O_WRONLY | os.O_CREAT | os.O_EXCL | os.O_NOFOLLOW, 0o600)
    except OSError:
        raise OutputError("the output file exists or cannot be made") from None
    with os.fdopen(fd, "w", encoding="utf-8", newline="") as f:
        f.write(text)


class JsonLines(logging.Formatter):
    """One JSON object a log record."""

    def format(self, record: logging.LogRecord) -> str:
        out = {"time": datetime.fromtimestamp(record.created, timezone.utc).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        if record.exc_info:
            out["error"] = self.formatException(record.exc_info)
        return json.dumps(out | getattr(record, "fields", {}), ensure_ascii=False, default=str)


def log_to_stderr(level: int = logging.INFO) -> None:
    handler = logging.StreamHandler(sys.stderr)
    handler.setFormatter(JsonLines())
    log = logging.getLogger("strandline")
    log.handlers[:], log.propagate = [handler], False
    log.setLevel(level)


_SECRET = re.compile(r"(?i)\b((?:password|passwd|secret|token|key)[\w.]*)\s*[=:]\s*[^\s,;&]+")
_PLACE = re.compile(r"(?i)\b(?:s3a?|gs|abfss?|hdfs|file|jdbc:\w+):/{1,3}[^\s'\"`,;)\]]+")


def redact(text: str, secrets: tuple[str, ...] = ()) -> str:
    """``text`` without the given secrets, key=value secrets and physical locations."""
    for s in sorted((s for s in secrets if s), key=len, reverse=True):
        text = text.replace(s, "[redacted]")
    return _PLACE.sub("[location]", _SECRET.sub(r"\1=[redacted]", text))
