"""Writing rollups and moving aged log files."""
