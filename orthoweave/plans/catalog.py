"""Every query of the engine with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orthoweave.plans import coarse, documents, frames, imagery, ledger, orbits, pairs, runs, scenes, strips  # noqa: F401  registers them
from orthoweave.plans.registry import REGISTERED

FLAGSHIP = "scene_affine_fit"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.run for name, q in REGISTERED.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTERED.items() if q.sql}
