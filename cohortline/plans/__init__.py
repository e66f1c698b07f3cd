"""Plans: compositions of the operators (the references pipelines)."""
