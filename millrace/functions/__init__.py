"""Column functions and user-function helpers."""
