"""Loads, reports and checks over the stored star schema."""
