"""Merkle manifest of a dataset: a tree of digests per source, one over the sources, and a proof per row.

Leaves are ranked inside their source by a range sort; every level is one grouping of three neighbours. The levels
are stored as rows that hold a stretch of the tree, three levels high, and a link to the node where it goes on.
A recursive query then climbs from every leaf: each step joins the stretch above the current node, notes the
siblings passed there, and folds the digest that started from the tampered leaf. Nothing is gathered beyond the
steps of one leaf, whose number is a third of the tree's height.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gantrylake.llm.rows import quoted
from gantrylake.llm.scratch import Scratch

#: Children of a node, levels that one step climbs, and the tree over the sources.
FAN = 3
HOPS = 3
TOP = -1
#: The number of a row inside its partition, as ``monotonically_increasing_id`` lays it out.
INSIDE = (1 << 33) - 1


def digest(*inputs: Column) -> Column:
    """H as 32 bytes: the digest of the inputs' concatenated text."""
    return F.unhex(F.sha2(F.concat(*inputs), 256))


def as_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def framed(value: Column) -> Column:
    """``-`` for NULL, else the length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The text without its line feeds where 2 divides the checksum of the id."""
    return F.when(F.crc32(doc_id.cast("string")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def ranked(rows: DataFrame, group: list[str], order: list[str], scratch: Scratch) -> DataFrame:
    """``rows`` with ``place``: the number of rows of the same group before each, by ``group`` and ``order``.

    A range sort spreads a group of any size over tasks; a row's place is its place in its sorted partition plus
    what earlier partitions hold of its group, a table of one row per partition and group.
    """
    spread = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    spread = scratch.write(spread.withColumn("_at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftrightunsigned("_at", 33)
    local = F.col("_at").bitwiseAND(F.lit(INSIDE))
    located = spread.withColumns({"_part": part, "_local": local}).drop("_at")
    sizes = located.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    starts = scratch.write(sizes.select(F.col("_part").alias("_p"), *[F.col(name).alias(f"_g{n}") for n, name in enumerate(group)], offset.alias("_offset")), "starts")
    same = located["_part"] == starts["_p"]
    for n, name in enumerate(group):
        same &= located[name].eqNullSafe(starts[f"_g{n}"])
    place = (F.col("_local") + F.col("_offset")).alias("place")
    return located.join(starts, same).select(*rows.columns, place)


def build_levels(nodes: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(nodes of all levels below the roots, roots) of trees whose lowest nodes are ``nodes``.

    Columns are tree, level, place, n (nodes that the tree has on the level) and digest.
    """
    inner, roots = [], []
    while True:
        roots.append(nodes.where("n = 1"))
        left = nodes.where("n > 1")
        inner.append(left)
        parent = F.call_function("div", F.col("place"), F.lit(FAN))
        grouped = left.groupBy("tree", "level", parent.alias("parent"), "n").agg(F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("run"))
        inputs = F.array_join(F.transform("run.digest", as_text), "")
        up = grouped.select(
            "tree",
            (F.col("level") + 1).alias("level"),
            F.col("parent").alias("place"),
            F.ceil(F.col("n") / FAN).cast("long").alias("n"),
            digest(inputs).alias("digest"),
        )
        nodes = scratch.write(up, "level")
        if not nodes.limit(1).count():
            return union(inner), union(roots)


def stretches(nodes: DataFrame) -> DataFrame:
    """Stretches of ``HOPS`` levels: tree, lowest level, place among the stretches there, the digests of each level
    in order (none for a level that the tree ends below), and the node where the climb goes on.

    A source's tree that ends in a stretch goes on as a leaf of the tree over the sources.
    """
    low = F.col("level") % HOPS
    width = F.element_at(F.array(*[F.lit(FAN**n) for n in range(HOPS, 0, -1)]), (low + 1).cast("int"))
    keyed = nodes.select(
        "tree",
        (F.col("level") - low).cast("int").alias("level"),
        F.call_function("div", F.col("place"), width).alias("above"),
        F.struct(low.alias("hop"), F.col("place").alias("at"), "digest").alias("node"),
        F.when(low == 0, F.col("n")).alias("n"),
    )
    grouped = keyed.groupBy("tree", "level", "above").agg(F.array_sort(F.collect_list("node")).alias("nodes"), F.max("n").alias("n"))
    ends = (F.col("n") <= FAN**HOPS) & (F.col("tree") != TOP)

    def of(hop: int) -> Column:
        return F.filter("nodes", lambda node: node["hop"] == hop)["digest"].alias(f"hop{hop}")

    return grouped.select(
        "tree",
        "level",
        "above",
        *map(of, range(HOPS)),
        F.when(ends, TOP).otherwise(F.col("tree")).cast("long").alias("up_tree"),
        F.when(ends, 0).otherwise(F.col("level") + HOPS).cast("int").alias("up_level"),
        F.when(ends, F.col("tree")).otherwise(F.col("above")).alias("up_place"),
    )


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


@contextmanager
def unbounded_recursion(spark: SparkSession) -> Iterator[None]:
    """Recursive queries may return as many rows as there are; their depth stays bounded by the setting for it."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _hop(hop: int) -> str:
    """One level up: a node's digest becomes its run's; the run's other digests are noted."""
    at = f"CAST(place DIV {FAN**hop} % {FAN ** (HOPS - hop)} AS INT)"
    text = "array_join(transform({}, x -> lower(hex(x))), '')"
    before = text.format(f"slice(hop{hop}, {at} - {at} % {FAN} + 1, {at} % {FAN})")
    after = text.format(f"slice(hop{hop}, {at} + 2, {FAN - 1} - {at} % {FAN})")
    beside = f"SELECT *, {before} AS before, {after} AS after"
    up = f"IF(size(hop{hop}) = 0, folded, unhex(sha2(concat(before, lower(hex(folded)), after), 256)))"
    return f"SELECT * EXCEPT (folded, siblings, before, after), {up} AS folded, concat(siblings, before, after) AS siblings FROM ({beside} FROM ({{}}))"


def climbed(spark: SparkSession, leaves: DataFrame, table: DataFrame) -> DataFrame:
    """One row per leaf and stretch on its way to the root: the folded digest and the siblings passed there."""
    step = f"""
        SELECT c.row, c.place, c.folded, '' AS siblings, s.*
        FROM climb c JOIN {{table}} s ON s.tree = c.tree AND s.level = c.level AND s.above = c.place DIV {FAN**HOPS}
    """
    for hop in range(HOPS):
        step = _hop(hop).replace("{}", step)
    query = f"""
    WITH RECURSIVE climb (row, tree, level, place, folded, siblings) AS (
        SELECT row, tree, level, place, tampered, CAST('' AS BINARY) FROM {{leaves}}
        UNION ALL
        SELECT row, up_tree, up_level, up_place, folded, unhex(siblings) FROM ({step})
    )
    SELECT * FROM climb
    """
    return spark.sql(query, leaves=leaves, table=table)


def merkle_manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified`` of every row.

    A row's leaf is the digest of its framed columns. Leaves of a source are ordered by id (NULL first, then by
    digest; rows equal in all columns are interchangeable), sources by name (NULL first). Every three neighbours
    become one node until one is left: the source's subroot, then the root. ``folded_root`` starts from
    the row with its line feeds taken out where the checksum of its id is even. Other columns are ignored. A lone leaf is its
    source's subroot. Empty and NULL texts are values like any other; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "manifest")

    def leaf(text: Column) -> Column:
        return digest(*[framed(text if name == text_col else quoted(name)) for name in columns])

    text = quoted(text_col).cast("string")
    leaves = docs.select(
        F.monotonically_increasing_id().alias("row"),
        quoted(id_col).alias("doc_id"),
        quoted(group_col).cast("string").alias("source"),
        leaf(text).alias("leaf"),
        leaf(tampered_text(quoted(id_col), text)).alias("tampered"),
    )
    leaves = scratch.write(leaves, "leaves")
    sources = leaves.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    # One row per partition has no group: the constant stands for the table.
    trees = ranked(sources.withColumn("all", F.lit(0)), ["all"], ["source"], scratch)
    trees = scratch.write(trees.select("source", "n", F.col("place").alias("tree")), "trees")
    placed = ranked(leaves, ["source"], ["doc_id", "leaf", "row"], scratch)
    of_source = F.broadcast(trees) if trees.count() <= 20_000 else trees
    placed = scratch.write(
        placed.join(of_source, placed["source"].eqNullSafe(trees["source"])).select("row", "doc_id", "leaf", "tampered", "tree", "place", "n"),
        "places",
    )
    lowest = placed.select("tree", F.lit(0).alias("level"), "place", "n", F.col("leaf").alias("digest"))
    inner, roots = build_levels(lowest, scratch)
    subroots = scratch.write(roots.select("tree", "digest"), "subroots")
    count = F.lit(subroots.count()).cast("long")
    tops = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("place"), count.alias("n"), "digest")
    outer, top = build_levels(tops, scratch)
    first = top.first()  # the one root
    root = F.lit(None).cast("binary") if first is None else F.lit(first["digest"])
    table = scratch.write(stretches(union([inner, outer])), "stretches")
    alone = F.col("n") == 1
    starts = placed.select(
        "row",
        F.when(alone, TOP).otherwise(F.col("tree")).cast("long").alias("tree"),
        F.lit(0).alias("level"),
        F.when(alone, F.col("tree")).otherwise(F.col("place")).alias("place"),
        "tampered",
    )
    with unbounded_recursion(spark):
        steps = climbed(spark, starts, table)
        height = F.struct((F.col("tree") == TOP).alias("top"), "level")
        passed = F.array_sort(F.collect_list(F.struct(height.alias("height"), "siblings")))
        proofs = steps.groupBy("row").agg(F.max_by("folded", height).alias("folded"), passed.alias("passed"))
        proof = F.sha2(F.array_join(F.transform(F.col("passed.siblings"), as_text), ""), 256)
        proofs = scratch.write(proofs.select("row", proof.alias("proof_sha256"), "folded"), "proofs")
    return scratch.finish(_result(placed, proofs, subroots, root))


def _result(placed: DataFrame, proofs: DataFrame, subroots: DataFrame, root: Column) -> DataFrame:
    of_tree = subroots.select("tree", F.col("digest").alias("subroot"))
    return (
        placed.join(proofs, "row")
        .join(of_tree, "tree")
        .select(
            "doc_id",
            as_text(F.col("leaf")).alias("leaf"),
            as_text(F.col("subroot")).alias("subroot"),
            as_text(root).alias("root"),
            "proof_sha256",
            as_text(F.col("folded")).alias("folded_root"),
            (F.col("folded") == root).alias("verified"),
        )
    )
