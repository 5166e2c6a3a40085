"""sharelens.functions."""
