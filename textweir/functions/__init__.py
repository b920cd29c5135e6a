"""Column functions and the small Arrow helpers."""
