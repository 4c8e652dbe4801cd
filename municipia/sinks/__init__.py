"""Writers of tables, packages and exports."""
