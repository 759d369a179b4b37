"""Column functions; every one is a built-in expression, none a Python function over rows."""
