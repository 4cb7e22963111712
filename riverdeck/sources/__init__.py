"""Landed JSON readers, table readers and sinks."""
