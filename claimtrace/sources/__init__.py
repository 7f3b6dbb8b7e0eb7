"""Files, grids, parsers and the versioned table folder."""
