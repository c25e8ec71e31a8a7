"""Operators on training text: mixing, filters, fingerprints, near copies, tokens.

Each module holds one operator with its own interface; ``queries`` applies them
to whole tables for the registered queries.
"""
