"""Catalog lookups, substring search, set differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.session import written

GRAM = 3
# Places of a letter group that are joined in one task, as long as few groups have more.
LEAST_PLACES, HOT_GROUPS = 50_000, 4_096


def point_lookup(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """requests(product_id, ...) with the product's columns and ``found``."""
    looked_up = requests.join(catalog, requests["product_id"] == catalog["id"], "left")
    return looked_up.withColumn("found", F.col("id").isNotNull()).drop("id")


def _places(text: Column, size: int) -> Column:
    """(gram, place) of every letter group of a text, in lower case."""
    starts = F.sequence(F.lit(0), F.length(text) - size)
    every = F.transform(starts, lambda i: F.struct(F.substring(text, i + 1, F.lit(size)).alias("gram"), i.alias("place")))
    return F.when(F.length(text) >= size, every)


def search_products(terms: DataFrame, catalog: DataFrame, *, places: int = LEAST_PLACES) -> DataFrame:
    """(query, id, name): products whose name or description contains the text, ignoring case.

    Texts are literal ('%' and '_' mean themselves); the empty text matches everything. Places of the letter
    groups that texts need are written once, with ids only. A text's rarest group gives the places where
    it can begin; its second rarest group has to lie at the right distance from there; what is left is tested
    on the product's texts. A text shorter than GRAM is its own letter group, so every text has one. A group
    with more than `places` places (and more than a 4,096th of all, so that there are at most 4,096 such
    groups) is dealt out by product.
    """
    distinct = terms.select("query").distinct()
    lowered = F.lower(F.col("query"))
    sized = distinct.filter("query is not null").withColumn("size", F.least(F.length(lowered), F.lit(GRAM)))
    asked = {r["size"] for r in sized.select("size").distinct().collect()}  # 0 to GRAM
    texts, sizes = sized.filter("size > 0"), sorted(asked - {0})
    name, description = F.lower("name"), F.lower("description")
    none = F.array().cast("array<struct<gram:string,place:int>>")
    grams = none
    for n in sizes:
        grams = F.when(F.col("size") == n, _places(lowered, n)).otherwise(grams)
    wanted = texts.select("query", F.inline(grams)).withColumnRenamed("place", "offset")

    every = [F.coalesce(_places(text, n), none) for n in sizes for text in (name, description)]
    fields = [f for _ in sizes for f in (0, 1)]
    found = reduce(DataFrame.unionByName, [
        catalog.select("id", F.lit(f).alias("field"), F.inline(e)) for e, f in zip(every, fields)
    ]) if sizes else catalog.select("id", F.lit(0).alias("field"), F.inline(none))
    postings = written(found.join(wanted.select("gram").distinct(), "gram", "left_semi"), "letter-groups")
    counts = written(postings.groupBy("gram").agg(F.count("*").alias("n")), "letter-counts")
    most = max(places, -(-(counts.agg(F.sum("n")).collect()[0][0] or 0) // HOT_GROUPS))
    shares = F.ceil(F.coalesce("n", F.lit(1)) / most).cast("int")

    # A text with a letter group no product has cannot match: its rarest group finds nothing.
    ranked = wanted.join(counts, "gram", "left").groupBy("query").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "offset"))).alias("groups")
    )
    first, second = F.col("groups")[0], F.get("groups", F.lit(1))
    anchors = ranked.select(
        "query", first["gram"].alias("gram"), first["offset"].alias("offset"), second["gram"].alias("other"),
        (second["offset"] - first["offset"]).alias("apart"), F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(first["n"] / most), F.lit(1)).cast("int") - 1)).alias("share"),
    )
    hot = counts.filter(F.col("n") > most).select("gram", shares.alias("shares"))
    share = F.pmod(F.xxhash64("id"), F.coalesce("shares", F.lit(1))).cast("int")
    dealt = postings.join(F.broadcast(hot), "gram", "left").withColumn("share", share).drop("shares")
    begun = anchors.join(dealt, ["gram", "share"]).select("query", "id", "field", "other", (F.col("place") + F.col("apart")).alias("place"))
    alone = begun.filter("other is null").select("query", "id")
    paired = begun.filter("other is not null").withColumnRenamed("other", "gram").join(postings, ["id", "field", "gram", "place"], "left_semi").select("query", "id")
    candidates = alone.union(paired).distinct()
    hits = candidates.join(catalog.select("id", "name", "description"), "id").filter(F.contains(name, lowered) | F.contains(description, lowered))
    hits = hits.select("query", "id", "name")
    return hits.unionByName(catalog.select(F.lit("").alias("query"), "id", "name")) if 0 in asked else hits


def not_in_cart(users_products: DataFrame, cart_items: DataFrame) -> DataFrame:
    """(user_id, product_id) pairs the user has not carted.

    Cart lines are reduced to distinct pairs before they move: copies of one pair would
    all go to one task.
    """
    carted = cart_items.select("user_id", "product_id").distinct()
    return users_products.join(carted, ["user_id", "product_id"], "left_anti")


def never_carted(catalog: DataFrame, cart_items: DataFrame) -> DataFrame:
    """Catalog ids that are in no cart."""
    carted = cart_items.select("product_id").distinct()
    return catalog.select(F.col("id").alias("product_id")).join(carted, "product_id", "left_anti")


def with_packaging(products: DataFrame, packaging: DataFrame) -> DataFrame:
    """Weight and size where known, NULL where not; no product is lost."""
    return products.join(packaging, "product_id", "left")


def cited_products(texts: DataFrame, ids: Column, catalog: DataFrame) -> DataFrame:
    """One row per cited id that is in the catalog; other ids are skipped."""
    cited = texts.withColumn("_ids", ids).select("*", F.posexplode("_ids").alias("cite_pos", "cited_id"))
    products = catalog.select(F.col("id").cast("string").alias("cited_id"), "name")
    return cited.drop("_ids").join(products, "cited_id")
