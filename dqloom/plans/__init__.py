"""From configuration to rules: reading, checking, ordering."""
