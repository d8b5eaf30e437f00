"""Catalog readers and writers: JSON files, flat relational tables, the assistant's JSON array."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.sources.fixed_values import IDENTIFIER_PATTERN

CATALOG_JSON_SCHEMA = (
    "products array<struct<id:string,name:string,description:string,picture:string,"
    "priceUsd:struct<currencyCode:string,units:bigint,nanos:int>,categories:array<string>>>"
)
ASSISTANT_ITEM = "struct<id:string,name:string,description:string,categories:array<string>>"
FLAT_COLUMNS = [
    "id", "name", "description", "picture", "price_usd_currency_code",
    "price_usd_units", "price_usd_nanos", "categories",
]


def money_struct(code: Column, units: Column, nanos: Column) -> Column:
    return F.struct(
        code.alias("currency_code"), units.cast("bigint").alias("units"), nanos.cast("int").alias("nanos")
    )


def _products(documents: DataFrame, products: Column) -> DataFrame:
    # inline, so that the array is parsed once and not once per field taken from it
    return documents.select(F.inline(products)).select(
        "id", "name", "description", "picture",
        money_struct(
            F.col("priceUsd.currencyCode"), F.col("priceUsd.units"), F.col("priceUsd.nanos")
        ).alias("price_usd"),
        "categories",
    )


def read_catalog_json(spark: SparkSession, path: str) -> DataFrame:
    """Files holding one object with a ``products`` array each."""
    documents = spark.read.schema(CATALOG_JSON_SCHEMA).option("multiLine", True).json(path)
    return _products(documents, F.col("products"))


def catalog_from_json(documents: DataFrame, column: str = "value") -> DataFrame:
    """The same objects, one per row of a text column."""
    return _products(documents, F.from_json(F.col(column), CATALOG_JSON_SCHEMA)["products"])


def catalog_from_flat(flat: DataFrame) -> DataFrame:
    """Eight flat columns to the nested model; categories are lower-cased and split on ','."""
    return flat.select(
        "id", "name", "description", "picture",
        money_struct(
            F.col("price_usd_currency_code"), F.col("price_usd_units"), F.col("price_usd_nanos")
        ).alias("price_usd"),
        F.split(F.lower("categories"), ",").alias("categories"),
    )


def flatten_catalog(catalog: DataFrame) -> DataFrame:
    """The nested model to eight flat columns; single quotes leave name and description."""
    quote = F.lit("'")
    return catalog.select(
        "id",
        F.replace("name", quote).alias("name"),
        F.replace("description", quote).alias("description"),
        "picture",
        F.col("price_usd.currency_code").alias("price_usd_currency_code"),
        F.col("price_usd.units").cast("int").alias("price_usd_units"),
        F.col("price_usd.nanos").cast("bigint").alias("price_usd_nanos"),
        F.concat_ws(",", "categories").alias("categories"),
    )


def write_flat_catalog(catalog: DataFrame, path: str) -> None:
    flatten_catalog(catalog).write.mode("overwrite").parquet(path)


def checked_identifier(name: str) -> str:
    """A table name that is a plain identifier, or an error."""
    if not re.fullmatch(IDENTIFIER_PATTERN.strip("^$"), name):
        raise ValueError(f"not a plain table name: {name!r}")
    return name


def load_catalog(spark: SparkSession, config: dict) -> DataFrame:
    """A flat table when the config names one, else a JSON file.

    Keys: ``table`` (with ``jdbc`` options when it lives in a database) or ``path``.
    """
    if config.get("table"):
        table = checked_identifier(config["table"])
        if config.get("jdbc"):
            flat = spark.read.format("jdbc").options(**config["jdbc"], dbtable=table).load()
        else:
            flat = spark.table(table)
        return catalog_from_flat(flat.select(*FLAT_COLUMNS))
    return read_catalog_json(spark, config["path"])


def assistant_items(documents: DataFrame, column: str = "value") -> DataFrame:
    """Rows of the items of JSON arrays; any other top level yields nothing."""
    is_array = F.ltrim(F.col(column)).startswith("[")
    parsed = F.from_json(F.col(column), f"array<{ASSISTANT_ITEM}>")
    return documents.filter(is_array).select(F.inline(parsed))


def read_assistant_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The assistant's catalog file; a missing file is an empty catalog."""
    try:
        documents = spark.read.text(path, wholetext=True)
    except (AnalysisException, Py4JJavaError) as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        print(f"warning: no assistant catalog at {path}")
        documents = spark.createDataFrame([], "value string")
    return assistant_items(documents)


def product_json(catalog: DataFrame) -> DataFrame:
    """Each product as one JSON text."""
    return catalog.select("id", F.to_json(F.struct(*catalog.columns)).alias("json"))
