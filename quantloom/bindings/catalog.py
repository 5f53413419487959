"""All bound queries; importing the modules registers them."""

from quantloom.bindings import standins  # noqa: F401  (must come first)
from quantloom.bindings import composite, ingest, learning, relational, series  # noqa: F401
from quantloom.bindings.registry import REGISTRY

__all__ = ["REGISTRY"]
