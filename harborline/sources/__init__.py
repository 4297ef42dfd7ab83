"""Sources: service pages, zone files, statistics tables."""
