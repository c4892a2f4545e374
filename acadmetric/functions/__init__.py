"""Column expressions shared by reports and operators; all stay inside the JVM."""
