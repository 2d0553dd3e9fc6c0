"""Typed readers, table writers and the stand-in tables built from the star schema."""
