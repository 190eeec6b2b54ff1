"""tallyfold: company and filing analytics as typed Spark DataFrame operators."""
