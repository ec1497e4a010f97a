"""Forecast bias correction on PySpark: training tables, models of the forecast error, gridding."""
