"""Spark-first analytics operators for panels, bars and text."""
