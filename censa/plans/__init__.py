"""censa.plans."""
