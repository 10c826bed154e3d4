"""Sinks: console, framed Kafka records, keyed upsert tables."""
