"""Lines that do not parse, as a table of their own.

The reader keeps every line: good ones typed, the others with their text and a reason. One
pass over the input writes both (as two partitions of one output) and counts them with
``observe``, so the counts cost no second scan and cannot disagree with what was written.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD = "_corrupt"


@dataclass
class Parsed:
    """What one pass wrote, and what it counted on the way."""
    good: DataFrame
    rejects: DataFrame  # line, reason
    n_good: int
    n_rejected: int


def json_rows(lines: DataFrame, schema: T.StructType, required: list[str], line: str = "value") -> DataFrame:
    """line, reason (null: good), row. A line is rejected if it is blank, if it is not
    JSON of the schema's types, or if a required field is absent or null."""
    text = F.col(line).cast("string")
    row = F.from_json(text, T.StructType([*schema.fields, T.StructField(BAD, T.StringType())]),
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    d = lines.select(text.alias("line"), row.alias("row"))
    reason = F.when(F.trim(F.coalesce("line", F.lit(""))) == "", "blank").when(F.col(f"row.{BAD}").isNotNull(), "malformed")
    for c in required:
        reason = reason.when(F.col("row")[c].isNull(), f"no {c}")
    return d.select("line", reason.alias("reason"), F.struct(*[F.col("row")[f.name].alias(f.name) for f in schema]).alias("row"))


def separated_rows(lines: DataFrame, sep: str, fields: list[str], line: str = "value") -> DataFrame:
    """line, reason, row for lines split at a literal separator; a line with fewer
    parts than ``fields`` is rejected, further parts are ignored."""
    text = F.col(line).cast("string")
    d = lines.select(text.alias("line"), F.split(text, r"\Q" + sep + r"\E", -1).alias("parts"))
    n = F.size("parts")
    reason = F.when(F.trim(F.coalesce("line", F.lit(""))) == "", "blank").when(n < len(fields), "too few fields")
    return d.select("line", reason.alias("reason"), F.struct(*[F.get("parts", F.lit(i)).alias(f) for i, f in enumerate(fields)]).alias("row"))


def write_parsed(rows: DataFrame, path: str) -> Parsed:
    """Write good rows and rejects of :func:`json_rows` or :func:`separated_rows` under
    ``path`` in one pass, with their counts."""
    seen = Observation(f"parsed-{uuid.uuid4().hex[:8]}")
    bad: Column = F.col("reason").isNotNull()
    counted = rows.observe(seen, F.count_if(~bad).alias("good"), F.count_if(bad).alias("rejected"))
    (counted.select(F.when(bad, "rejects").otherwise("good").alias("kind"), F.when(bad, F.col("line")).alias("line"), "reason",
                    F.when(~bad, F.col("row")).alias("row"))
     .write.partitionBy("kind").parquet(path))
    spark = rows.sparkSession
    schema = T.StructType([T.StructField("line", T.StringType()), T.StructField("reason", T.StringType()),
                           T.StructField("row", rows.schema["row"].dataType), T.StructField("kind", T.StringType())])
    out = spark.read.schema(schema).parquet(path)
    return Parsed(out.where("kind = 'good'").select("row.*"), out.where("kind = 'rejects'").select("line", "reason"),
                  seen.get["good"], seen.get["rejected"])
