"""The engine's input shapes over the test tables, the queries on them, and their SQL."""
