"""Whole programs built from the operators: training recipes, tuning, reports."""
