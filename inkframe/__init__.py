"""inkframe: a Spark-native engine for story data (documents, candidates, decisions, pointers)."""
