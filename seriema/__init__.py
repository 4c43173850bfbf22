"""seriema: economic and other periodic time series on Spark DataFrames."""

from .model import Series

__all__ = ["Series"]
