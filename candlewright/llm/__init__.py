"""Operators for preparing large text corpora (each module's docstring states its
method and what it does with nulls, empty texts, ties and repeated rows)."""
