"""sources of the evidence-graph library."""
