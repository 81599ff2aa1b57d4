"""Frame to frame operators."""
