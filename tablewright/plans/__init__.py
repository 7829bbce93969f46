"""The registered queries: every operator at work on the test tables, next to the SQL it must agree with."""

from __future__ import annotations

from . import combining, converting, nesting, selecting, writing

CATALOGUES = tuple(module.catalogue for module in (selecting, combining, nesting, converting, writing))


def runnable() -> dict:
    return {name: run for catalogue in CATALOGUES for name, run in catalogue.runnable().items()}


def sql() -> dict[str, str]:
    return {name: text for catalogue in CATALOGUES for name, text in catalogue.sql.items()}
