"""tabforge.plans."""
