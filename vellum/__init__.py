"""vellum: a document-corpus engine on PySpark DataFrames."""
