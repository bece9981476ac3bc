"""tabforge.functions."""
