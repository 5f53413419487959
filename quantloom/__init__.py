"""quantloom: keyed time-series analytics for equity panels, written as Spark plans."""

__version__ = "0.1.0"
