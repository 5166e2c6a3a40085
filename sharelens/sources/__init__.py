"""sharelens.sources."""
