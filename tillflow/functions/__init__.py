"""Column functions: dates, money, user labels, JSON records, text search."""
