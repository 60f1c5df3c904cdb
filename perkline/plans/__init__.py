"""Table models from bronze to BI."""
