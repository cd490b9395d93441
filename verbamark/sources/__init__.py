"""Where lines and tables are read from and written to."""
