"""Structured Streaming forms of the plan-log operators."""
