"""Telemetry streaming."""
