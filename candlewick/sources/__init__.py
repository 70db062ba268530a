"""Table sources: stand-in tables derived from the driver's parquet, file scans, sinks."""
