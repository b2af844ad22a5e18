"""Declared schemas (the reference's documents are schemaless; here every collection is a StructType)."""

from __future__ import annotations

from pyspark.sql import types as T

ARTICLE_FIELDS = ["_id", "headline", "description", "severity", "main_risk", "country", "state", "link"]

ARTICLE = T.StructType(
    [T.StructField("_id", T.StringType(), False)]
    + [T.StructField(f, T.StringType(), True) for f in ARTICLE_FIELDS[1:]]
)

ARTICLE_FLAGS = T.StructType([
    T.StructField("is_checked", T.BooleanType(), True),
    T.StructField("editorial", T.BooleanType(), True),
    T.StructField("is_editorial", T.BooleanType(), True),
    T.StructField("is_deduplicated", T.BooleanType(), True),
])

PROCESSED_ARTICLE = T.StructType(list(ARTICLE.fields) + [
    T.StructField("summary", T.StringType(), True),
    T.StructField("extracted_affected_port", T.StringType(), True),
    T.StructField("extracted_date", T.StringType(), True),
    T.StructField("is_new", T.BooleanType(), True),
    T.StructField("is_unique", T.BooleanType(), True),
    T.StructField("final_risk", T.StringType(), True),
    T.StructField("severity_level", T.IntegerType(), True),
    T.StructField("severity_label", T.StringType(), True),
])

EXTRACTION = T.StructType([
    T.StructField("_id", T.StringType(), True),
    T.StructField("event", T.StringType(), True),
    T.StructField("port_affected", T.StringType(), True),
    T.StructField("date", T.StringType(), True),
])

CATEGORY = T.StructType([
    T.StructField("_id", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("description", T.StringType(), True),
    T.StructField("origin", T.StringType(), False),  # seed | discovered
])

PREDICTION = T.StructType([
    T.StructField("severity_level", T.IntegerType(), True),
    T.StructField("severity_label", T.StringType(), True),
    T.StructField("confidence", T.DoubleType(), True),
])

# The 13 seed risk categories (id, name, description), in id order.
SEED_CATEGORIES = [
    (1, "Vessel Delay", "Delays in vessel schedules affecting port operations and shipping timelines."),
    (2, "Vessel Accidents", "Accidents involving vessels, impacting safety, cargo, and port operations."),
    (3, "Maritime Piracy/Terrorism Risk", "Risks from piracy or terrorism targeting vessels, cargo, or routes."),
    (4, "Port or Important Route Congestion", "Congestion at ports or critical routes, delaying vessel movement."),
    (5, "Port Criminal Activities", "Illegal activities at ports, impacting security and cargo safety."),
    (6, "Cargo Damage and Loss", "Loss or damage to cargo during transportation or handling processes."),
    (7, "Inland Transportation Risks", "Risks in land transport affecting cargo or vessel schedules."),
    (8, "Environmental Impact and Pollution", "Pollution or environmental damage caused by maritime activities or spills."),
    (9, "Natural Extreme Events and Extreme Weather", "Severe weather or natural events affecting maritime routes or ports."),
    (10, "Cargo or Ship Detainment", "Cargo or vessels detained due to inspections, regulations, or disputes."),
    (11, "Unstable Regulatory and Political Environment", "Political instability or regulatory changes affecting maritime operations."),
    (12, "Others", "Maritime events outside predefined categories requiring separate classification."),
    (13, "Not maritime-related", "Events unrelated to maritime activities or not impacting the maritime sector."),
]
