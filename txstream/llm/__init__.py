"""Training-data operators and the corpus pipeline's building blocks.

Nothing else in the library imports this subpackage.
"""
