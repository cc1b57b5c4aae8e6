"""operators of the evidence-graph library."""
