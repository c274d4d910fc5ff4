"""Whole analyses, composed from the operators into one lazy plan each."""
