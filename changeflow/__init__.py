"""changeflow: current state, marts and data contracts from row-change events, on Spark."""
