"""Reading and writing plan logs."""
