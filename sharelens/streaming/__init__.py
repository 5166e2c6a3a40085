"""sharelens.streaming."""
