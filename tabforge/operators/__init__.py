"""tabforge.operators."""
