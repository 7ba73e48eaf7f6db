"""Work driven by newly arrived files."""
