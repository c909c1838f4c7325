"""DataFrame -> DataFrame operators: statistics, curves, metrics, quality, explanation."""
