"""censa.streaming."""
