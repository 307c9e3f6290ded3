"""ledgerline: a layered (Bronze / Silver / Gold) sales model on Spark DataFrames."""

__version__ = "0.1.0"
