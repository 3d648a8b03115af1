"""Arrival-driven loads with Structured Streaming."""
