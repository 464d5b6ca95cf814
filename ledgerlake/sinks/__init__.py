"""Sinks: versioned table directories."""
