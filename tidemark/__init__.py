"""Analytics over valid-time tables, written as Spark DataFrame operators."""
