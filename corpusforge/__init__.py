"""corpusforge: composable PySpark operators for curating text corpora."""

__version__ = "0.1.0"
