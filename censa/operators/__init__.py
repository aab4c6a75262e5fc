"""censa.operators."""
