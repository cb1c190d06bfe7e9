"""PySpark-native analytics over reorg-aware event logs."""
