"""DataFrame-level operators reused by several analyses."""
