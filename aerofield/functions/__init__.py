"""Column functions: geometry, frames and projections, wind and text."""
