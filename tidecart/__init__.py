"""tidecart: sales and cart analytics as Spark DataFrame and Structured Streaming operators."""
