"""Readers, bindings of the driver's tables to the impression-log roles, writers."""
