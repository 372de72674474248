"""PySpark-native engine for posting quality pipelines and corpus preparation."""
