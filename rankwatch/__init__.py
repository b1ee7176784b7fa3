"""Risk ranking and batch monitoring on Spark DataFrames."""

from rankwatch.config import Config

__all__ = ["Config"]
