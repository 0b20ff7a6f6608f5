"""Full rebuild of gold from silver, and the checks that decide whether it becomes current."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakemart.lake import Lake
from lakemart.plans import GOLD, MODELS
from lakemart.plans.checks import gate, run_checks
from lakemart.session import scratch_scope


def stage_gold(lake: Lake) -> None:
    """Stage every gold model, dependencies first; later models read the earlier ones from their files."""
    with scratch_scope(lake.spark):
        try:
            for model in GOLD:
                lake.stage(model)
        finally:
            lake.forget_unpublished()


def build_gold(lake: Lake) -> None:
    """Rebuild gold without checks: all models become current together, or none if one fails."""
    lake.release_read()
    stage_gold(lake)
    lake.release()


def check_gold(lake: Lake) -> DataFrame:
    return run_checks(lake, list(MODELS))


def rebuild(lake: Lake) -> None:
    """Stage all models, check them, then make them current; raises when a check fails, and gold stays as it was."""
    lake.release_read()
    stage_gold(lake)
    gate(check_gold(lake))
    lake.release()
