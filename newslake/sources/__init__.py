"""Sources and sinks: tables, ad-hoc SQL, CSV/Parquet in place, JSON listings."""
