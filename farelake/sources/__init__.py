"""Inputs and outputs: driver tables, the booking fixture, CSV files, lake tables."""
