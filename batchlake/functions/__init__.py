"""Column expressions. All built-in, so they stay inside generated JVM code."""
