"""DataFrame operators: cleaning, sampling, splits, panels, counts, series."""
