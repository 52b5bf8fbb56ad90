"""Column-to-Column helpers, all inside the JVM."""
