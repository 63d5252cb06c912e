"""Composed queries: each module exposes ``QUERIES`` (name -> (spark, sf_dir)
-> DataFrame) and ``ORACLES`` (name -> DuckDB SQL over the same tables)."""
