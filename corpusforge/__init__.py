"""corpusforge: instruction-backtranslation corpora with PySpark."""
