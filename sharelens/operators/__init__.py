"""sharelens.operators."""
