"""lakeforge: DataFrame operators for landing, merging, checking and governing tables."""
