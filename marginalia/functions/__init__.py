"""Column-level helpers; everything here returns a Column and runs in the JVM."""
