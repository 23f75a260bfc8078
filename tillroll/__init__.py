"""Receipt history on Spark: daily raw files in, clean receipts, errors and shop ids out."""
