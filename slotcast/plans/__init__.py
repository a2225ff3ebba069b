"""Whole jobs, composed of operators into one lazy plan each."""
