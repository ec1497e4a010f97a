"""Whole jobs composed of operators, each one lazy plan."""
