"""Bronze -> Silver -> Gold -> mining as an ordered set of datasets.

Each dataset is a function of the datasets before it.  With an output root
every dataset is written as a Parquet table (the Gold analyses partitioned by
month) and re-read, which cuts lineage between stages and lets a later run
start from any stage; without one the whole chain stays lazy.
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowlog.config import MiningConfig
from flowlog.operators import conformance as cf, eventlog as el, network as sn, transitions as tr, \
    variants as mv
from flowlog.plans import hospital as h

Context = dict[str, DataFrame]


class AbsentInput(LookupError):
    """A dataset needs an input that is not there."""


class _Inputs(dict):
    def __missing__(self, name):
        raise AbsentInput(name)


Dataset = Callable[[Context], DataFrame]


def datasets(cfg: MiningConfig, as_of: _dt.date | str, noise_threshold: float = 0.0) -> dict[str, Dataset]:
    """The ordered dataset definitions."""
    out: dict[str, Dataset] = {}
    for name, spec in h.SILVER.items():
        out[name] = (lambda s: lambda ctx: h.build_silver(ctx[s.bronze], s))(spec)
    out["silver_expectations"] = silver_expectations
    out["gold_event_log"] = event_log
    out["gold_case_attributes"] = lambda ctx: h.gold_case_attributes(
        ctx["silver_epidemio"], ctx["silver_atendimento_emergencia"])
    out["gold_data_quality"] = lambda ctx: h.gold_data_quality(ctx["gold_event_log"], as_of)
    out["gold_variant_analysis"] = lambda ctx: mv.variants(ctx["gold_event_log"], cfg, as_of)
    out["gold_bottleneck"] = lambda ctx: tr.bottlenecks(ctx["gold_event_log"], cfg)
    out["gold_performance_spectrum"] = lambda ctx: tr.performance_spectrum(ctx["gold_event_log"], cfg)
    out["gold_conformance"] = lambda ctx: cf.conformance(ctx["gold_event_log"], cfg, noise_threshold)
    out["gold_sna_handover"] = lambda ctx: sn.handover_between_sources(ctx["gold_event_log"], cfg)
    out["gold_sna_subcontracting"] = lambda ctx: sn.subcontracting_between_sources(ctx["gold_event_log"], cfg)
    out["gold_sna_handover_specialty"] = lambda ctx: sn.handover(ctx["gold_event_log"], cfg)
    out["gold_sna_subcontracting_specialty"] = lambda ctx: sn.subcontracting(ctx["gold_event_log"], cfg)
    out["gold_sna_subcontracting_source"] = lambda ctx: sn.subcontracting(
        ctx["gold_event_log"], cfg, actor="source", segment=None)
    return out


def event_log(ctx: Context) -> DataFrame:
    """The Gold log of the Silver tables in ``ctx`` (all of them, unless absent ones are skipped)."""
    silver = {k: ctx[k] for k in h.SILVER if k in ctx}
    if not silver:
        raise AbsentInput("no Silver table")
    return h.gold_event_log(silver)


def silver_expectations(ctx: Context) -> DataFrame:
    """Expectation results of every Silver table in ``ctx``, one table."""
    parts = [h.silver_metrics(ctx[name], spec) for name, spec in h.SILVER.items()
             if name in ctx and spec.rules]
    if not parts:
        raise AbsentInput("no Silver table with expectations")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run(spark: SparkSession, bronze: Context, as_of: _dt.date | str, out_root: str | None = None,
        cfg: MiningConfig = MiningConfig(), noise_threshold: float = 0.0,
        only: set[str] | None = None, skip_absent: bool = False) -> Context:
    """Build every dataset; write and re-read each when ``out_root`` is set.

    A dataset whose input is absent raises :class:`AbsentInput`; with
    ``skip_absent`` it is left out instead. Other errors always surface.
    """
    ctx: Context = _Inputs(bronze)
    partition = {"gold_bottleneck": ["month"], "gold_performance_spectrum": ["month"],
                 "gold_conformance": ["month"], "gold_sna_handover": ["month"],
                 "gold_sna_subcontracting": ["month"]}
    live = datasets(cfg, as_of, noise_threshold)
    for name in list(live):
        if only is not None and name not in only:
            continue
        if name == "gold_data_quality" and "gold_event_log" in ctx:
            # one hot-case sample for every mining dataset of this log
            cfg_log = el.with_hot_cases(ctx["gold_event_log"], cfg)
            live.update(datasets(cfg_log, as_of, noise_threshold))
        try:
            df = live[name](ctx)
        except AbsentInput:
            if not skip_absent:
                raise
            continue
        if out_root:
            path = os.path.join(out_root, name)
            writer = df.write.mode("overwrite")
            if name in partition:
                writer = writer.partitionBy(*partition[name])
            writer.parquet(path)
            # the schema is given so an empty result (no files) still reads back
            df = spark.read.schema(df.schema).parquet(path).select(*df.columns)
        ctx[name] = df
    return ctx
