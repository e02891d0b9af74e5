"""Refines batches of station and reading documents into a star schema, on Spark."""

from rivulet.errors import ValidationError

__all__ = ["ValidationError"]
