"""Event building, rolling statistics and stream clustering."""
