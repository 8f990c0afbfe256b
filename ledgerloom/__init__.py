"""ledgerloom: retail and card analytics expressed as Spark DataFrame operators."""
