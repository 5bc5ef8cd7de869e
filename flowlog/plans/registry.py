"""The registered query set: Spark builders and their DuckDB oracle SQL.

Every builder takes ``(spark, base_dir)`` and reads whole driver tables;
``ORACLE`` holds the equivalent DuckDB SQL for the keys that have one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import os

from flowlog.config import MiningConfig, SkewConfig

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}

# FLOWLOG_SKEW_MODE / FLOWLOG_BUCKET_ROWS let tests force the hot-key split path.
CFG = MiningConfig(
    skew=SkewConfig(mode=os.environ.get("FLOWLOG_SKEW_MODE", "detect"),
                    bucket_rows=int(os.environ.get("FLOWLOG_BUCKET_ROWS", str(SkewConfig().bucket_rows)))))
AS_OF = "2026-03-31"
NOISE = 0.2
SALT = "flowlog-demo-salt"


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


MODULES = ("q_eventlog", "q_mining", "q_model", "q_quality", "q_io", "q_hospital", "q_exports")  # order matters: later ones reuse SQL


def _load() -> None:
    import importlib
    import importlib.util

    for m in MODULES:
        name = f"flowlog.plans.{m}"
        if importlib.util.find_spec(name) is not None:
            importlib.import_module(name)


_load()
