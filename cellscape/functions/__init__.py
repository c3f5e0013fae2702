"""Column-level helpers (JVM-side expressions only, no Python UDFs)."""
