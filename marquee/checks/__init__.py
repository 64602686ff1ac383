"""The registered queries and, where SQL can express them, the same results in SQL."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Check(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name, sql=None):
    """Registers ``run(spark, folder)`` under ``name``."""

    def register(run):
        if name in CHECKS:
            raise ValueError(f"query {name} registered twice")
        CHECKS[name] = Check(run, sql)
        return run

    return register


def load_all():
    from marquee.checks import (  # noqa: F401
        tables, fields, reports, similar, searches, live, requests, learned, composed,
    )

    return CHECKS
