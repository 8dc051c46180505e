"""Relational operators: SCD2 rewrite, as-of joins, fraud rules."""
