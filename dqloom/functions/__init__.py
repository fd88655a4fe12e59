"""Column expressions for cleaning and reading text. Everything here stays inside Catalyst."""
