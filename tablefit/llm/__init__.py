"""Operators for preparing language-model training text, and their queries.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
its queries when it is present.
"""
