"""tessera: the analyses as PySpark DataFrame operators and pipelines."""
