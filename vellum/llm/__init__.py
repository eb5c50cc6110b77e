"""Training-data operators: one module per operator, their queries and SQL oracles.

Nothing else in the library imports this subpackage.
"""
