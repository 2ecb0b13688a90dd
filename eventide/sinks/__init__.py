"""Writers for batch and streaming DataFrames."""
