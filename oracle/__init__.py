"""Independent DuckDB SQL for the correctness gate (tables are the driver's views)."""
