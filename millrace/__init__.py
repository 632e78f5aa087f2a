"""millrace: a PySpark-native engine for turning web documents into reviewable tables."""
