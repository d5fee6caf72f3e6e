"""All queries of the library, and their SQL."""

from __future__ import annotations

from bidweave.fixtures import analysis, changing, oracle, queries


def build() -> dict[str, queries.Query]:
    return queries.build() | changing.build() | analysis.build()


def sql() -> dict[str, str]:
    return oracle.build() | analysis.sql()
