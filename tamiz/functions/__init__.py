"""Column functions; all run in the JVM except the pair scorer in ``similarity``."""
