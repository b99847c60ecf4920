"""roadlens: a PySpark-native engine for object-detection data and training corpora."""
