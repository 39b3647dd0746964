"""DataFrame-to-DataFrame building blocks that the plans are put together from."""
