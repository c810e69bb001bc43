"""Schemas of the source files: raw headers, the names they get, and Spark types."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw header of the listing file (fixed values: the file's own column names),
# in file order, next to the snake_case name each is renamed to.
RAW_HEADER = [
    ("id", "id"),
    ("Date", "date_serial"),
    ("number of bedrooms", "bedrooms"),
    ("number of bathrooms", "bathrooms"),
    ("living area", "sqft_living"),
    ("lot area", "sqft_lot"),
    ("number of floors", "floors"),
    ("waterfront present", "waterfront"),
    ("number of views", "view"),
    ("condition of the house", "condition"),
    ("grade of the house", "grade"),
    ("Area of the house(excluding basement)", "sqft_above"),
    ("Area of the basement", "sqft_basement"),
    ("Built Year", "yr_built"),
    ("Renovation Year", "yr_renovated"),
    ("Postal Code", "zipcode"),
    ("Lattitude", "lat"),
    ("Longitude", "long"),
    ("living_area_renov", "sqft_living15"),
    ("lot_area_renov", "sqft_lot15"),
    ("Number of schools nearby", "schools_nearby"),
    ("Distance from the airport", "airport_distance_km"),
    ("Price", "price"),
]

# Numbers are read as doubles: files write integers as 3.0 and day numbers as 42492.0.
LISTINGS = T.StructType([T.StructField(raw, T.LongType() if new == "id" else T.DoubleType()) for raw, new in RAW_HEADER])
SERIES = T.StructType([T.StructField("country_code", T.StringType()), T.StructField("date", T.StringType()), T.StructField("price", T.StringType())])
# Second-market columns that are text; all others are numbers.
SECOND_MARKET_TEXT = ("date", "waterfront", "condition")
