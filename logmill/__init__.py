"""logmill: log and trace analytics as Spark DataFrame operators."""
