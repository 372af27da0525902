"""Everything that touches paths, catalogs or external systems."""
