"""Column functions: calendar, nested records, numbers and text."""
