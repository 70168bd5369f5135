"""Table registry, batch and stream readers."""
