"""Independent DuckDB SQL for the correctness oracle (see ``__spark_entry__.oracle_sql``)."""
