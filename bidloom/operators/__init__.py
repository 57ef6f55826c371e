"""DataFrame operators: classification, extraction, mapping, status, validation, loading, reports."""
