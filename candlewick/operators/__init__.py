"""DataFrame -> DataFrame operators (windows, recursive indicators, aggregates, stats, ML)."""
