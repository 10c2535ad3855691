"""Operators of a training-data pipeline: each module is one operator with its own interface."""
