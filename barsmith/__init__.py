"""Candles, indicators, multi-timeframe bars and alert rules as Spark DataFrames."""
