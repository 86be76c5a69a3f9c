"""Files, tables, views and the console."""
