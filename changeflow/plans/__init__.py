"""The shop models: current-state tables, the order mart, and how they are published."""
