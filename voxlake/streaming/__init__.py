"""Structured Streaming: publish, consume to bronze, late data, windowed marts."""
