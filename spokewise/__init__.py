"""Business data wrangling and sales analytics as plain functions over Spark DataFrames."""
