"""Independent DuckDB SQL used as the correctness oracle."""
