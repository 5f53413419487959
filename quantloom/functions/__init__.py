"""Column-level functions: scalar expressions and windowed macros."""
