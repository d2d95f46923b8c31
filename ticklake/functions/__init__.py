"""Column -> Column helpers (cleaning, labels, numeric rounding)."""
