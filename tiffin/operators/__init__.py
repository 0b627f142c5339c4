"""Reusable DataFrame operators: cleaning, audit, checks and cohort totals."""
