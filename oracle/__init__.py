"""The same results in DuckDB SQL, for the correctness check.

Each text is written independently of the Spark code: windows over all rows,
plain joins and direct ranking, which is fine at test size.
"""

from oracle.build import oracle_queries

__all__ = ["oracle_queries"]
