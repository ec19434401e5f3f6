"""DataFrame operators, from raw traces to training rows and comparisons."""
