"""attesta: a PySpark-native engine for evidence-anchored claim analytics."""
