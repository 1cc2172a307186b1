"""Column-to-column functions; all of them run in the JVM, in batch and on streams."""
