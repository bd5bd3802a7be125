"""Spark-first analytics for hourly energy, price and weather feeds."""
