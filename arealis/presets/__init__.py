"""Fixed values of the published tables: column lists, code mappings and rule tables."""
