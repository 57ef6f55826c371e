"""bidloom: bid-document analytics expressed as Spark DataFrame operators."""
