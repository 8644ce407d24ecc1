"""Column functions: text, dates, genres, numbers."""
