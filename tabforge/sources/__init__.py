"""tabforge.sources."""
