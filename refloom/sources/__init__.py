"""Readers: zip archives, lenient CSV, dBASE attribute tables, GeoJSON, catalog JSON."""
