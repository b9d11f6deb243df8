"""Snapshot sources, sinks and the test-table bindings."""
