"""A copy of what a command prints."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from pathlib import Path


class _Tee:
    def __init__(self, stream, log):
        self.stream, self.log = stream, log

    def write(self, text: str) -> int:
        try:
            self.log.write(text)
        except (OSError, ValueError):  # the copy never stops the command
            pass
        return self.stream.write(text)

    def flush(self) -> None:
        try:
            self.log.flush()
        except (OSError, ValueError):
            pass
        self.stream.flush()

    def __getattr__(self, name: str):
        return getattr(self.stream, name)


@contextmanager
def transcript(command: str, folder: str | None) -> Iterator[Path | None]:
    """Copies stdout and stderr into a new file of the folder; where that can't be, the command runs without a copy."""
    path = None
    try:
        if folder:
            Path(folder).mkdir(parents=True, exist_ok=True)
            path = Path(folder) / f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{command}.log"
            log = path.open("x", encoding="utf-8")
    except OSError:
        path = None
    if path is None:
        yield None
        return
    out, err = sys.stdout, sys.stderr
    sys.stdout, sys.stderr = _Tee(out, log), _Tee(err, log)
    try:
        yield path
    finally:
        sys.stdout, sys.stderr = out, err
        log.close()
