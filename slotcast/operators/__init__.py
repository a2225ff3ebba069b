"""DataFrame-to-DataFrame operators on keyed, regular time series."""
