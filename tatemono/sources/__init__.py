"""Schemas, readers, sinks, scratch tables and the driver-table adapter."""
