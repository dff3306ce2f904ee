"""Universes from stored raw responses: one payload per block, or the four levels of a hierarchy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import label_with_id, label_with_optional_id
from ..operators.contracts import union, violations
from ..operators.joins import apply_exclusions, payload_contract
from ..operators.reshape import payload_rows
from .trees import parent, relative_path

PROVENANCE = "retrieved_utc string, year string, state string, state_value string, district string, district_value string, block string, block_value string, url string, http_status string, n_rows string, sha256 string"


def stored_payloads(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(place, body, sha256) of every stored response called ``name``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name).load(root)
    return files.select(parent(relative_path(root, "path")).alias("place"), F.col("content").cast("string").alias("body"), F.sha2("content", 256).alias("sha256"))


def stored_provenance(spark: SparkSession, root: str, name: str, schema: str = PROVENANCE) -> DataFrame:
    df = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", name).json(root)
    return df.select(parent(relative_path(root)).alias("place"), "*")


def universe_from_payloads(payloads: DataFrame, provenance: DataFrame, id_column: str = "gp_code") -> tuple[DataFrame, DataFrame]:
    """Units of all stored block payloads with their provenance, and violations (hash, status, counts, rows, labels)."""
    rows, sentinels, bad = payload_rows(payloads, ["place"], "body", id_column, sentinel="any")
    counts = payloads.select("place", "sha256").join(rows.groupBy("place").agg(F.count("*").alias("n_rows")), "place", "left").na.fill(0, ["n_rows"])
    joined, wrong = payload_contract(counts, provenance, "place")
    named = rows.withColumn("unit_name", label_with_optional_id("label", "id"))
    labels = violations(named.where("id is not null"), "label", F.col("unit_name").isNull(), ["place", "id"], F.col("label"))
    units = named.join(joined.drop("n_rows", "stated_rows", "stated_sha256"), "place")
    return units.withColumnRenamed("id", "unit").drop("label", "position"), union(bad, wrong, labels)


def universe_from_levels(levels: DataFrame, names: list[str], exclusions: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Walk a hierarchy from stored responses.

    ``levels`` has (year, level, parent, body, sha256): the response that lists the children of ``parent`` (the path of
    ids from the top, joined by '/'), ``names`` the levels' names from the top. ``exclusions`` (year, path,
    source_sha256) drops reviewed members of the second level. Gives units with an id and a label for every level,
    sentinels per level and year, and violations.
    """
    place = ["year", "level", "parent", "sha256"]
    parsed, sentinels, bad = payload_rows(levels, place, "body", "id", sentinel="last")
    parsed = parsed.where("id is not null").withColumn("name", label_with_id("label", "id"))
    problems = [bad, violations(parsed, "label", F.col("name").isNull(), ["year", "level", "parent", "id"], F.col("label"))]
    out = None
    for depth, name in enumerate(names):
        here = parsed.where(F.col("level") == name).select("year", "parent", F.col("id").alias(f"{name}_value"), F.col("name").alias(name), F.col("sha256").alias(f"{name}_sha256"))
        here = here.withColumn("path", F.concat_ws("/", F.when(F.col("parent") != "", F.col("parent")), F.col(f"{name}_value")))
        if depth == 1 and exclusions is not None:
            here, changed = apply_exclusions(here, exclusions, ["year", "path"], f"{name}_sha256")
            problems.append(changed)
        if out is None:
            out = here.drop("parent")
        else:
            out = out.withColumnRenamed("path", "parent").join(here, ["year", "parent"]).drop("parent")
    per_level = sentinels.groupBy("year", "level").agg(F.sum("sentinels").alias("sentinels"))
    return out.drop("path"), per_level, union(*problems)
