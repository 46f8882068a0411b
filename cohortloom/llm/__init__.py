"""Training-data operators: ten jobs over documents, pages and benchmark items.

Nothing else in the package imports this subpackage.
"""
