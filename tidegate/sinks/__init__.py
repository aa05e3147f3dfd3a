"""Writers of result files."""
