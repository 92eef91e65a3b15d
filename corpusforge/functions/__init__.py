"""corpusforge subpackage."""
