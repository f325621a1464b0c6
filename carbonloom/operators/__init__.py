"""DataFrame-in, DataFrame-out operators; none knows a file or a country."""
