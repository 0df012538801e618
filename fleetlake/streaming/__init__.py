"""Structured Streaming: landing, watermarked KPIs, stream dedupe, metric sinks."""
