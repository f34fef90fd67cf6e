"""Telemetry derived from the events table, and the registered queries on it."""
