"""Incremental processing of new deliveries with Structured Streaming."""
