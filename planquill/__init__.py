"""A PySpark-native engine for query-plan logs and the workloads they describe."""
