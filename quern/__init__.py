"""quern: a Spark-native engine for document collections and their knowledge artefacts."""

__version__ = "0.1.0"
