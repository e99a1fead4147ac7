"""All queries of the library and their SQL."""

from __future__ import annotations

from ledgerloom.queries import composite, general, relational, scalars, sources
from ledgerloom.queries.common import Query

MODULES = [general, relational, scalars, composite, sources]
FLAGSHIP = "star_denorm"


def queries() -> dict[str, Query]:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.SQL.items()}
