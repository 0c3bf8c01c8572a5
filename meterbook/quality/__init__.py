"""Data quality: reusable rules, the catalog of checks, and the history of their outcomes."""
