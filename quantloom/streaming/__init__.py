"""Continuous loading of landed files."""
