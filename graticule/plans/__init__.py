"""Whole workflows: a scenario, its indices, its diagnostics."""
