"""Column-role registry, end-to-end pipelines and the registered queries."""
