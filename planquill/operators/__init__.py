"""Relational operators over tables and over the plan log."""
