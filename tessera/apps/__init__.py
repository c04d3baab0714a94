"""Applications of the operators: the survey load + reports, and the model flows."""
