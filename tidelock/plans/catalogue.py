"""All queries of the engine by name, and the SQL that checks them."""

from __future__ import annotations

from functools import cache

from . import identity, reconciliation, relational, replication
from .registry import Catalogue, Query


@cache
def _all() -> Catalogue:
    out = Catalogue()
    for module in (relational, reconciliation, replication, identity):
        module.register(out)
    return out


def queries() -> dict[str, Query]:
    return dict(_all().queries)


def oracles() -> dict[str, str]:
    return dict(_all().oracles)
