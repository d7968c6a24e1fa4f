"""Boundary to what runs outside Spark: networks, matchers, image tools, portals.

The engine takes their results as tables. Each interface is a schema and a function of rows; a worker that has the model
or tool fills it, and the stand-ins here are deterministic so that plans can be run and tested without one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: Output of each kind of external worker.
SCHEMAS = {
    "dense_matches": "scene string, id string, is_anchor boolean, ref_x double, ref_y double, off_x double, off_y double, confidence double, prec double",
    "flow": "tile long, r int, c int, x double, y double, certainty double",
    "warped_tiles": "tile long, px array<double>",
    "portal_scenes": "entity_id string, dataset string, url string, bytes long, status string",
    "basemap_tiles": "layer string, zoom int, x long, y long, status int, content binary",
    "camera_pose": "entity_id string, position array<double>, rotation array<double>",
}

Worker = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]
_workers: dict[str, Worker] = {}


def register(kind: str, worker: Worker) -> None:
    if kind not in SCHEMAS:
        raise ValueError(f"unknown kind of worker: {kind}; known are {', '.join(sorted(SCHEMAS))}")
    _workers[kind] = worker


def run(kind: str, rows: DataFrame) -> DataFrame:
    """Rows through the registered worker, or the stand-in, partition by partition."""
    return rows.mapInPandas(_workers.get(kind) or _stand_in(kind), SCHEMAS[kind])


def _stand_in(kind: str) -> Worker:
    names = [f.split()[0] for f in SCHEMAS[kind].split(", ")]

    def worker(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """What the input has of the columns asked for, without change; the rest is unknown."""
        for f in frames:
            yield f.reindex(columns=names)

    return worker
