"""Connected components of an edge table."""

from chunkloom.operators.graphs import components

__all__ = ["components"]
