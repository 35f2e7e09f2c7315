"""siltstone: a PySpark-native engine for curating and auditing training corpora."""
