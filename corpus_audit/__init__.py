"""corpus_audit: Spark operators for auditing and reconciling document corpora."""
