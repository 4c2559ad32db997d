"""Sources and sinks: catalog, registry views, raw CSV, Parquet, CSV export, links, archives, API pages."""
