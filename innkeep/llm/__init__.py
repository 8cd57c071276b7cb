"""Operators of a training-data pipeline on Spark; nothing else in the library imports them."""
