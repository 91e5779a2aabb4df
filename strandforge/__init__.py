"""strandforge: a PySpark analytics engine for catalogues of biological sequences."""
