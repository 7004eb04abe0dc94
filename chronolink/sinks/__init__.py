"""Writers for edges and split pages."""
