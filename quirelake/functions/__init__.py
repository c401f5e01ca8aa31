"""Column -> Column building blocks; none of them leaves the JVM."""
