"""Reading and writing tables, fingerprints and run bundles."""
