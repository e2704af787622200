"""Where the source and the mirror are, and how long to wait for the source."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from .manifest import MANIFEST, Manifest


@dataclass(frozen=True)
class Settings:
    source: str
    mirror: str
    manifest_path: str | None = None
    seed: int = 42
    #: Seconds to wait for a source that can't be reached, and for one that refuses.
    unreachable_seconds: float = 180.0
    refused_seconds: float = 60.0

    @classmethod
    def from_env(cls, environ: Mapping[str, str] | None = None, **known) -> Settings:
        """From TIDELOCK_SOURCE, TIDELOCK_MIRROR and so on; what is given by name goes before, and all faults are told at once."""
        environ = os.environ if environ is None else environ
        kinds = {"source": str, "mirror": str, "manifest_path": str, "seed": int, "unreachable_seconds": float, "refused_seconds": float}
        found, faults = {}, []
        for name, kind in kinds.items():
            text = known.get(name, environ.get(f"TIDELOCK_{name.upper()}"))
            if text is None or text == "":
                if name in ("source", "mirror"):
                    faults.append(f"TIDELOCK_{name.upper()} is not set")
                continue
            try:
                found[name] = kind(text)
            except ValueError:
                faults.append(f"TIDELOCK_{name.upper()} is no {kind.__name__}: {text!r}")
        if faults:
            raise ValueError("; ".join(faults))
        return cls(**found)

    def manifest(self) -> Manifest:
        return Manifest.load(self.manifest_path) if self.manifest_path else MANIFEST
