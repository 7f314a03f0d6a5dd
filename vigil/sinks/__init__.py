"""Sinks: Kafka envelopes, Parquet / CSV tables, replay-safe daily stores, bundles."""
