"""Reading and writing of topics and tables."""
