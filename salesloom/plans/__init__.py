"""Jobs over files and tables, and the registered query catalogue."""
