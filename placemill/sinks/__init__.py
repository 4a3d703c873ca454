"""Writers: parquet, CSV, GeoJSON lines."""
