"""Gridded climate scenarios as Spark DataFrame jobs."""

from .session import scratch_dir, tune

__all__ = ["scratch_dir", "tune"]
__version__ = "0.1.0"
