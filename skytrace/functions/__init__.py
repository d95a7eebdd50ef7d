"""Column-returning functions: geometry, projections, text."""
