"""Operators for preparing training text: deduplication, filtering, formatting
and tokenising, each as a Spark job over whole tables.

Nothing else in the library imports this package.
"""
