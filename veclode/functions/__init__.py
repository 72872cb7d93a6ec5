"""Column -> Column functions; all native expressions, no Python runs per row."""
