"""Reading and writing: event logs, stored tables, JSON."""
