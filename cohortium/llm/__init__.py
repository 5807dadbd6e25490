"""Training-data operators: ten text, archive and packing operators and their queries.

Nothing else in the library imports this subpackage.
"""
