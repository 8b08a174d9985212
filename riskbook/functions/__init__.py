"""Column-level helpers: date windows, tax-id check digits, hash ranks,
size-checked broadcast joins."""
