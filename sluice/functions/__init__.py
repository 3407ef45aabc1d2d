"""Column functions: text clean-up, dates, numbers and field encryption."""
