"""Writers of change logs and tables."""
