"""Telemetry sources."""
