"""Reading and writing the model's tables."""
