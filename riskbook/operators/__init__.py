"""Relational operators, one module per stage of the reference."""
