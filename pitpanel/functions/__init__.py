"""Column-expression helpers (pure ``pyspark.sql.functions`` compositions)."""

from pitpanel.functions.exprs import *  # noqa: F401,F403
