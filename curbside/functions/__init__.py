"""Column-level helpers; every one is a plain Column expression."""
