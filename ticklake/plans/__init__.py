"""Composed analytical plans (the reference's views and reports)."""
