"""Plans: wiring of operators into the mart, learning pipelines, the query registry."""
