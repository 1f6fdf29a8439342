"""terracask: a PySpark-native engine for gridded change analytics."""
