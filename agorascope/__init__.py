"""A PySpark-native engine for analysing online discussions."""
