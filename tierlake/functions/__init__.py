"""Column functions: text, JSON kinds and numbers. All run inside the JVM."""
