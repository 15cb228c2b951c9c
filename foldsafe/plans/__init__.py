"""End-to-end plans: stand-in frames over the driver tables and the
registered queries (each with its DuckDB oracle)."""
