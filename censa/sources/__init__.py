"""censa.sources."""
