"""Column functions; every one stays a JVM-side expression."""
