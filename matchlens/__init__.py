"""Team-game match analytics as PySpark DataFrame operators."""
