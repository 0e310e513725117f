"""JSON records holding a list, expanded to one row per list element, each with a message.

Record layout: ``{"number": n, "people": [{"craft": ..., "name": ...}, ...]}`` where ``number`` is the
declared length of ``people``. ``expand_records`` parses the text with an explicit schema
(``from_json``), explodes the list and formats one message per person; ``number_matches`` tells
whether the declared count agrees with the list. Records are built from table rows here
(``customer_records``), one record per customer, so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values (must equal the reference's behaviour) -----------------------------------------
GREETING = "Hello! :)"
MESSAGE_FORMAT = "%s is currently in space flying on the %s! %s"
# --------------------------------------------------------------------------------------------------

PERSON = T.StructType([T.StructField("craft", T.StringType()), T.StructField("name", T.StringType())])
RECORD = T.StructType([T.StructField("number", T.LongType()), T.StructField("people", T.ArrayType(PERSON))])


def customer_records(customers: DataFrame, nations: DataFrame) -> DataFrame:
    """``value``: one JSON record per customer; the nation name is the craft."""
    c = customers.select("c_custkey", "c_name", "c_nationkey")
    n = nations.select("n_nationkey", "n_name")
    people = F.array(F.struct(F.col("n_name").alias("craft"), F.col("c_name").alias("name")))
    return c.join(n, c.c_nationkey == n.n_nationkey, "inner").select(
        F.to_json(F.struct(F.size(people).cast("bigint").alias("number"), people.alias("people"))).alias("value")
    )


def expand_records(records: DataFrame, greeting: str = GREETING, column: str = "value") -> DataFrame:
    """``number, craft, name, message, number_matches``: one row per person of every record."""
    parsed = records.select(F.from_json(F.col(column), RECORD).alias("r")).select("r.number", "r.people")
    return parsed.select(
        "number",
        (F.size("people") == F.col("number")).alias("number_matches"),
        F.explode("people").alias("p"),
    ).select(
        "number",
        F.col("p.craft").alias("craft"),
        F.col("p.name").alias("name"),
        F.format_string(MESSAGE_FORMAT, F.col("p.name"), F.col("p.craft"), F.lit(greeting)).alias("message"),
        "number_matches",
    )
