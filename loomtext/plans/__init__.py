"""Queries over the driver's tables, and the SQL that states each of them."""
