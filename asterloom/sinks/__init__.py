"""Writers: layout, write modes, catalog tables."""
