"""The registered queries."""

from layerframe.workload import catalog, metadata, planning, quality, rows, scans, summaries  # noqa: F401
from layerframe.workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
