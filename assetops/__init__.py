"""Equipment-maintenance analytics on Spark DataFrames."""

from assetops.clock import Clock
from assetops.schema import Tables

__all__ = ["Clock", "Tables"]
