"""Query catalogue: each entry takes (spark, sf_dir) and returns a DataFrame.

``catalog.QUERIES`` are the Spark plans; ``oracle.ORACLE_SQL`` holds the
equivalent DuckDB SQL over the same driver tables.
"""
