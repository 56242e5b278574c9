"""Column-level building blocks: calendar, bands, flags, fills."""
