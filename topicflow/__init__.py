"""What is trending, where and when: a PySpark-native engine for streams of short geo-tagged messages."""
