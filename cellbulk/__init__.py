"""Single-cell pseudobulk analytics expressed as Spark DataFrame operators."""
