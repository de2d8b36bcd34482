"""Commerce analytics on Spark: star schema, reports, features, models, forecasts."""
