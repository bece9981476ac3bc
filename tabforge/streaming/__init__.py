"""tabforge.streaming."""
