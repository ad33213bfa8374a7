"""DataFrame-in, DataFrame-out operators. Operators start no jobs unless their docstring says so."""
