"""Telemetry plans."""
