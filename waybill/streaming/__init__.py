"""Structured Streaming: the batch plans per micro-batch, and windowed counts."""
