"""Layer jobs: raw files to bronze, silver, gold and forecast tables."""
