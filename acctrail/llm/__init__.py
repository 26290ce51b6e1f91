"""Operators for preparing large text corpora for model training.

Nothing else in the library imports this package. ``queries`` holds the
registered queries, the other modules one operator each.
"""
