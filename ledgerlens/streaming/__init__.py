"""Structured Streaming versions of the batch transforms (same functions,
``readStream``/``writeStream`` around them, checkpoints in shared storage)."""
