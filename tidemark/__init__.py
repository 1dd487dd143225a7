"""tidemark: lakehouse data operators as plain PySpark DataFrame functions."""
