"""Daily market surveillance and portfolio analytics as Spark DataFrame plans."""
