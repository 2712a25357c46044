"""Whole dataflows, from input tables to reports."""
