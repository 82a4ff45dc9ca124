"""DataFrame-in, DataFrame-out operators of the four analyses."""
