"""slotcast: demand-forecasting data operators on Spark DataFrames."""

from .grid import Grid
from .session import prepare

__all__ = ["Grid", "prepare"]
