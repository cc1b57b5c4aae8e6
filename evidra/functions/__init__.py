"""functions of the evidence-graph library."""
