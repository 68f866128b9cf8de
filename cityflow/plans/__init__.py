"""Whole jobs: bronze, silver and gold tables, and the measures over the star schema."""
