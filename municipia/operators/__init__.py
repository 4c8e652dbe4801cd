"""DataFrame operators; column names are arguments with the canonical names as defaults."""
