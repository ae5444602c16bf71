"""Jobs: the monthly run, the catalogue of cuts, captions."""
