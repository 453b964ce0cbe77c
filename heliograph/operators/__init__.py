"""Telemetry operators."""
