"""Relational operators over telemetry frames."""
