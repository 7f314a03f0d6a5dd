"""Structured Streaming: watermarked metrics, dedup, replay-safe stores, runners."""
