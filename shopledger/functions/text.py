"""Text expressions of the assistant and the request log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopledger.sources.fixed_values import (
    CLIENT_ID_PATTERN,
    ID_FOOTER_LABEL,
    LIST_TAIL_PATTERN,
    NO_MATCH,
    SERVER_ID_PATTERN,
    WORD_BREAK_PATTERN,
)


def tokens(text: Column) -> Column:
    """Distinct lower-case alphanumeric tokens, in order of first use."""
    return F.array_distinct(F.filter(F.split(F.lower(text), WORD_BREAK_PATTERN), lambda t: t != ""))


def feature_text(name: Column, description: Column, categories: Column) -> Column:
    empty = F.lit("")
    return F.concat_ws(
        " ",
        F.coalesce(name, empty),
        F.coalesce(description, empty),
        F.coalesce(F.array_join(categories, " "), empty),
    )


def has_cited_id(text: Column) -> Column:
    return text.rlike(SERVER_ID_PATTERN)


def cited_ids(text: Column) -> Column:
    """Every bracketed id in order, repeats kept; ids with '_' are not product ids."""
    return F.regexp_extract_all(text, F.lit(CLIENT_ID_PATTERN), F.lit(1))


def fallback_ids(ids: Column, n: int = 3) -> Column:
    best = F.slice(ids, 1, n)
    return F.when(F.size(best) > 0, best).otherwise(F.array(F.lit(NO_MATCH)))


def rstrip(text: Column) -> Column:
    """Drop trailing whitespace of any kind (rtrim drops blanks only)."""
    return F.regexp_replace(text, r"\s+$", "")


def with_id_footer(text: Column, ids: Column) -> Column:
    """The reply as it is when it cites an id, else with the first fallback ids appended."""
    bracketed = F.transform(fallback_ids(ids), lambda i: F.concat(F.lit("["), i, F.lit("]")))
    footer = F.concat(rstrip(text), F.lit("\n" + ID_FOOTER_LABEL), F.array_join(bracketed, ", "))
    return F.when(has_cited_id(text), text).otherwise(footer)


def without_list_tail(text: Column) -> Column:
    return F.regexp_replace(text, LIST_TAIL_PATTERN, "")


def percent_decoded(text: Column) -> Column:
    """URL-decoded text; '+' stays '+', and text with a malformed escape stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def metadata_id(doc_json: Column) -> Column:
    """Id of a retrieved document: top level, else either place its metadata may be."""
    paths = ("$.id", "$.raw.kwargs.metadata.id", "$.metadata.id")
    return F.coalesce(*[F.get_json_object(doc_json, p) for p in paths])


def metadata_ids(doc_json: Column) -> Column:
    """All ids of a retrieved document: its own, or else those of both its metadata; texts only.

    Repeats are dropped, order is kept.
    """

    def given(path: str) -> Column:
        # A text value keeps its quotes in the variant's JSON, a number has none.
        found = F.try_variant_get(F.try_parse_json(doc_json), path, "variant")
        return F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(found, "$", "string"))

    inside = F.array(given("$.raw.kwargs.metadata.id"), given("$.metadata.id"))
    ids = F.when(given("$.id").isNotNull(), F.array(given("$.id"))).otherwise(inside)
    return F.array_distinct(F.filter(ids, lambda i: i.isNotNull()))


def escaped_label(value: Column) -> Column:
    """Metric label escaping, applied once."""
    swaps = (("\\", "\\\\"), ("\n", "\\n"), ('"', '\\"'))
    return reduce(lambda col, s: F.replace(col, F.lit(s[0]), F.lit(s[1])), swaps, value)
