"""Column expressions. Everything here stays on the JVM: no Python UDFs."""
