"""Column functions: money, text and time."""
