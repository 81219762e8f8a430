"""DataFrame -> DataFrame building blocks (no I/O inside, so batch and
streaming plans share them)."""
