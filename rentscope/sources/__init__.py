"""Sources and sinks: derived listings, web pages, CSV/Parquet datasets,
snapshots, the star warehouse and zone publishing."""
