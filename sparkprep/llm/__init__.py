"""Operators of a training-data pipeline, each by one stated method."""
