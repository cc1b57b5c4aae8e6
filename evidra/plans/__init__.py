"""Queries over the driver's tables, each bound to the library's operators."""
