"""The marts: each job chains operators and tables from landing to gold."""
