"""Structured Streaming forms: stateful processors, jobs, restart."""
