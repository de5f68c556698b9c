"""skein: a PySpark-native engine for curating and scoring paired text corpora."""
