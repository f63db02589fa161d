"""DataFrame -> DataFrame operators. Lazy, JVM-side, no driver loops over rows."""
