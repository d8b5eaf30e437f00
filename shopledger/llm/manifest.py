"""Merkle manifest of a table of documents, with proofs by pointer jumping.

A row is a leaf. Per language, leaves ascend by id; every run of ARITY consecutive nodes becomes one
node of the level above, until one node, the subroot, is left; the subroots, ordered by language, are
the leaves of a top tree in the same way, and what is left there is the root.

The nodes of a run have the same siblings and the same ancestors, so a run is a row: its nodes' digests
(one segment of the proofs) and a pointer to the run that its own digest lies in. A self-join of
the runs along their pointers takes every run as far again as it had come and appends the segments
it has passed, so the distance doubles each round, until all runs of leaves have reached the root.
A leaf's proof is the segments of its run, without the nodes on its own way.

Places of leaves come from a range-partitioned sort and counts per partition, so no task sorts a
language. A run is pointed at from ARITY^d others at distance d, while runs with d levels below them
are so many times fewer than leaves: Spark broadcasts them by their measured size, or splits the
pointers of a skewed join. Levels and rounds are written to the shared folder.

Defined results: null fields are hashed as `-`; a null id comes before all others and counts as the empty
text where ids are hashed for tampering; a null language is a language of its own, the first; rows of
one id follow each other by their digests, exact twins in any order; a language of one row has
its leaf as its subroot; a table of one row has its leaf as the root and an empty proof; texts of any
length are hashed whole; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopledger.llm.common import remainder, written

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = -1  # the number of the tree of subroots
DIGITS = 64  # of a digest in hexadecimal


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(inputs: Column) -> Column:
    return F.sha2(inputs.cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf, and the leaf of the tampered row (null where the row stays as it is)."""
    given = [field(F.col(c)) for c in FIELDS]
    changed = [*given[:-1], field(F.translate("text", UPPER, LOWER))]
    hit = (remainder(F.col("doc_id"), 3) == 0) & F.col("text").rlike("[A-Z]")
    return docs.select(
        F.col("doc_id"), F.col("lang"), digest(F.concat(*given)).alias("leaf"), F.when(hit, digest(F.concat(*changed))).alias("tampered")
    )


def numbered(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """rows with `place` (from 0, without gaps) in their key's order, and `total`, the key's rows.

    Sorted by ranges of (key, order); rows equal in all of these are told apart by where they
    were read, so that repeated rows do not gather in one range.
    """
    sorted_by = [F.col(c).asc_nulls_first() for c in (key, *order, "_read")]
    at = rows.withColumn("_read", F.monotonically_increasing_id())
    at = at.repartitionByRange(*sorted_by).sortWithinPartitions(*sorted_by).drop("_read")
    at = written(at.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    parts = at.groupBy(key, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))  # a row for each range and key in it
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col(key).alias("_key"), F.col("_part").alias("_in"), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(key)).alias("total"),
    )
    return (
        at.join(parts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_in")))
        .withColumn("place", F.col("_before") + F.col("_at") - F.col("_first"))
        .drop("_part", "_at", "_key", "_in", "_first", "_before")
    )


def above(total: Column) -> Column:
    return F.floor((total + ARITY - 1) / ARITY)


def runs_of(nodes: DataFrame, level: int, *held: str) -> DataFrame:
    """The runs of nodes (tree, total, place, digest): segment (their digests), own digest, and what the nodes hold.

    A tree of one node has a run without a segment, whose digest is the node's.
    """
    inside = F.array_sort(F.collect_list(F.struct("place", "digest", *held)))
    digests = F.array_join(F.transform("inside", lambda n: n["digest"]), "")
    many = F.col("total") > 1
    return (
        nodes.groupBy("tree", "total", F.floor(F.col("place") / ARITY).alias("run")).agg(inside.alias("inside"))
        .withColumn("digests", digests)
        .select(
            "tree", F.lit(level).alias("level"), "run", "total", F.when(many, F.unhex("digests")).alias("segment"),
            F.when(many, digest(F.col("digests"))).otherwise(F.col("digests")).alias("digest"),
            F.transform("inside", lambda n: F.struct(*[n[c].alias(c) for c in held])).alias("held") if held else F.lit(None).alias("held"),
        )
    )


def levels_above(runs: DataFrame, level: int, most: int) -> list[DataFrame]:
    """The runs of all further levels of trees with at most so many nodes on the level of the given runs."""
    made = []
    while most > ARITY:
        most, level = -(-most // ARITY), level + 1
        on = runs.filter(F.col("total") > ARITY).select("tree", above(F.col("total")).alias("total"), F.col("run").alias("place"), "digest")
        runs = written(runs_of(on, level), "runs")
        made.append(runs)
    return made


def height(nodes: int) -> int:
    n = 0
    while nodes > 1:
        nodes, n = -(-nodes // ARITY), n + 1
    return n


def pointers(runs: DataFrame, trees: int) -> DataFrame:
    """Runs that know themselves and the run above: path of segments, and places on the way (`at`, of the run's digest in the run above)."""
    on, across = F.col("total") > ARITY, (F.col("tree") != TOP) & F.lit(trees > 1)
    last = ~on & (F.col("tree") != TOP)

    def up(inside: Column, outside) -> Column:
        return F.when(on, inside).when(across, F.lit(outside) if isinstance(outside, int) else outside)

    at = up(F.col("run") % ARITY, F.col("tree") % ARITY).cast("int")
    return runs.select(
        "tree", "level", "run", "held", (F.col("total") > 1).alias("hashed"),
        up(F.col("tree"), TOP).cast("long").alias("up_tree"), up(F.col("level") + 1, 0).cast("int").alias("up_level"),
        up(F.floor(F.col("run") / ARITY), F.floor(F.col("tree") / ARITY)).cast("long").alias("up_run"),
        F.array_compact(F.array("segment")).alias("path"), F.array_compact(F.array(at)).alias("at"),
        F.when(last, F.col("digest")).alias("subroot"), F.when(~on & ~across, F.col("digest")).alias("root"),
    )


def jumped(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """rows as far again as they have come: pointers, paths and what was found are taken over from the run pointed at."""
    goal = targets.select(
        F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("run").alias("up_run"), F.col("up_tree").alias("_tree"),
        F.col("up_level").alias("_level"), F.col("up_run").alias("_run"), F.col("path").alias("_path"), F.col("at").alias("_at"),
        F.col("subroot").alias("_subroot"), F.col("root").alias("_root"),
    )
    more = lambda a, b: F.concat(F.col(a), F.coalesce(F.col(b), F.array().cast(dict(rows.dtypes)[a]))).alias(a)
    return rows.join(goal, ["up_tree", "up_level", "up_run"], "left").select(
        "tree", "level", "run", "held", "hashed", F.col("_tree").alias("up_tree"), F.col("_level").alias("up_level"), F.col("_run").alias("up_run"),
        more("path", "_path"), more("at", "_at"), F.coalesce("subroot", "_subroot").alias("subroot"), F.coalesce("root", "_root").alias("root"),
    )


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, and proof (the siblings' digests, level by level) of every row."""
    rows = numbered(written(leaves(docs), "leaves"), "lang", ["doc_id", "leaf"])
    one = rows.filter("place = 0").select("lang", F.col("total").alias("nodes"), F.lit(0).alias("all"))
    langs = written(numbered(one, "all", ["lang"]).select(F.col("lang").alias("_lang"), F.col("place").alias("tree"), "nodes"), "languages")
    trees, most = langs.agg(F.count("*"), F.coalesce(F.max("nodes"), F.lit(0))).collect()[0]
    nodes = rows.join(langs.drop("nodes"), F.col("lang").eqNullSafe(F.col("_lang"))).withColumn("digest", F.col("leaf"))
    first = written(runs_of(nodes, 0, "doc_id", "leaf", "tampered"), "runs")

    def plain(runs: DataFrame) -> DataFrame:
        return runs.withColumn("held", F.lit(None).cast(first.schema["held"].dataType))

    made = [first, *map(plain, levels_above(first, 0, most))]
    if trees > 1:
        subroots = [r.filter(F.col("total") <= ARITY).select(F.lit(TOP).alias("tree"), F.lit(trees).alias("total"), F.col("tree").alias("place"), "digest") for r in made]
        top = written(runs_of(reduce(DataFrame.union, subroots), 0), "runs")
        made += map(plain, [top, *levels_above(top, 0, trees)])
    now = pointers(reduce(DataFrame.unionByName, [r.select("tree", "level", "run", "total", "segment", "digest", "held") for r in made]), trees)
    bottom = (F.col("tree") != TOP) & (F.col("level") == 0)
    distance, steps = 1, max(height(most), 1) + height(trees)  # runs from a run of leaves to the last one, at most
    while distance < steps:
        now = written(now, "pointers")
        targets = now.filter((F.col("tree") == TOP) | (F.col("level") >= distance)).drop("held")
        now = jumped(now.filter(bottom) if 2 * distance >= steps else now, targets)
        distance *= 2
    return folded(now.filter(bottom))


def folded(runs: DataFrame) -> DataFrame:
    """The leaves of runs that know their whole path, with their proofs, checked."""
    each = runs.select("path", "at", "hashed", "subroot", "root", F.posexplode("held").alias("own", "item"))
    ways = F.when(F.col("hashed"), F.concat(F.array("own"), "at")).otherwise(F.col("at"))
    step = F.transform(
        F.arrays_zip(ways.alias("at"), F.col("path")),
        lambda s: F.struct((s["at"] * DIGITS).alias("cut"), F.lower(F.hex(s["path"])).alias("hex")),
    )
    left = lambda s: F.substr(s["hex"], F.lit(1), s["cut"])
    right = lambda s: F.substr(s["hex"], s["cut"] + DIGITS + 1)
    leaf = F.coalesce(F.col("item.tampered"), F.col("item.leaf"))
    return (
        each.withColumn("steps", step)
        .withColumn("proof", F.array_join(F.transform("steps", lambda s: F.concat(left(s), right(s))), ""))
        .withColumn("folded_root", F.aggregate("steps", leaf, lambda acc, s: digest(F.concat(left(s), acc, right(s)))))
        .select(
            F.col("item.doc_id").alias("doc_id"), F.col("item.leaf").alias("leaf"), "subroot", "root", digest(F.col("proof")).alias("proof_sha256"),
            "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "proof",
        )
    )


def _sql(levels: int, top_levels: int) -> str:
    """DuckDB SQL of `manifest` for trees of at most so many levels."""
    def item(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"

    others = " || ".join(item(c) for c in FIELDS[:-1])
    # crc32 of the decimal id, bit by bit: -1 stands for a shift
    crc = (
        "xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
        "lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))), "
        "lambda r, b: CASE WHEN b >= 0 THEN xor(r, b) WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END), 4294967295)"
    )
    out = [
        f"given AS (SELECT doc_id, lang, text, coalesce({crc}, 0) % 3 = 0 AS hit, {others} AS others FROM documents)",
        f"leaves AS MATERIALIZED (SELECT doc_id, lang, sha256(others || {item('text')}) AS leaf, CASE WHEN hit THEN "
        f"sha256(others || {item(f"translate(text, '{UPPER}', '{LOWER}')")}) ELSE sha256(others || {item('text')}) END AS tampered FROM given)",
        "trees AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER () AS trees FROM (SELECT DISTINCT lang FROM leaves))",
        "placed AS MATERIALIZED (SELECT l.*, tree, trees, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, "
        "count(*) OVER (PARTITION BY tree) AS total FROM leaves l JOIN trees t ON l.lang IS NOT DISTINCT FROM t.lang)",
        "a0 AS (SELECT tree, total, place, leaf AS digest FROM placed)",
    ]

    def grow(name: str, count: int) -> None:
        for k in range(count):
            out.append(
                f"{name}{k + 1} AS MATERIALIZED (SELECT tree, (total + 7) // 8 AS total, place // 8 AS place, list(digest ORDER BY place) AS inside, "
                f"sha256(string_agg(digest, '' ORDER BY place)) AS digest FROM {name}{k} WHERE total > 1 GROUP BY ALL)"
            )

    def climb(name: str, way: str, count: int) -> None:
        for k in range(count):
            out.append(
                f"{way}{k + 1} AS (SELECT w.* REPLACE (w.place // 8 AS place, coalesce(sha256(array_to_string(inside[:w.place % 8], '') || now || "
                f"array_to_string(inside[w.place % 8 + 2:], '')), now) AS now, proof || coalesce(array_to_string(inside[:w.place % 8], '') || "
                f"array_to_string(inside[w.place % 8 + 2:], ''), '') AS proof) FROM {way}{k} w LEFT JOIN {name}{k + 1} r ON r.tree = w.tree AND r.place = w.place // 8)"
            )

    grow("a", levels)
    ends = " UNION ALL ".join(f"SELECT tree, digest FROM a{k} WHERE total = 1" for k in range(levels + 1))
    out.append(f"subroots AS MATERIALIZED ({ends})")
    out.append("b0 AS (SELECT 0 AS tree, (SELECT count(*) FROM subroots) AS total, tree AS place, digest FROM subroots)")
    grow("b", top_levels)
    roots = " UNION ALL ".join(f"SELECT digest AS root FROM b{k} WHERE total = 1" for k in range(top_levels + 1))
    out.append("w0 AS (SELECT doc_id, leaf, tree AS own, tree, place, tampered AS now, '' AS proof FROM placed)")
    climb("a", "w", levels)
    out.append(f"v0 AS (SELECT * REPLACE (0 AS tree, own AS place) FROM w{levels})")
    climb("b", "v", top_levels)
    body = ",\n".join(out)
    return (
        f"WITH {body}\nSELECT doc_id, leaf, s.digest AS subroot, root, sha256(proof) AS proof_sha256, now AS folded_root, now = root AS verified\n"
        f"FROM v{top_levels} v JOIN subroots s ON s.tree = v.own, ({roots})"
    )


#: For up to 8^7 documents a language and 8^4 languages.
SQL = _sql(7, 4)
