"""Re-usable relational operators built from DataFrame primitives."""
