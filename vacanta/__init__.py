"""Job-advert analytics as Spark DataFrame transformations."""
