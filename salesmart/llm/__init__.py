"""Training-data operators: one module an operator, their queries in ``queries`` and SQL in ``oracle``.

Nothing else in the library imports this package.
"""
