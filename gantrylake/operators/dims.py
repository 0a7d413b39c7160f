"""The gantry dimension: enrichment, version comparison, extraction from manual text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gantrylake.functions.text import WHITESPACE_CLASS, tidy_label
from gantrylake.schemas import GANTRY_ID_PATTERN
from gantrylake.session import fresh_path
from gantrylake.sinks.lake import materialise

ENTRY_PATTERN = f"({GANTRY_ID_PATTERN}){WHITESPACE_CLASS}+([^\\n]{{2,}})"


def enrich_dimension(
    new: DataFrame,
    legacy: DataFrame,
    defaults: DataFrame,
    overrides: DataFrame,
    key: str = "gantry_id",
    attributes: Sequence[str] = ("county", "city", "note"),
) -> DataFrame:
    """New dimension rows with attributes from the old version.

    Per attribute: the old value, else the default for that id, else empty; an override replaces
    whatever stands there, by an empty text too. Joins carry no hint: the two patch tables are
    small and Spark's size check broadcasts them, the old version only if it fits.
    """
    patched = new
    for prefix, table in (("old", legacy), ("default", defaults), ("override", overrides)):
        names = [a for a in attributes if a in table.columns]
        side = table.select(key, *[F.col(a).alias(f"_{prefix}_{a}") for a in names])
        patched = patched.join(side, key, "left")

    def value(attribute: str) -> Column:
        found = lambda prefix: F.col(f"_{prefix}_{attribute}")
        parts = [F.nullif(found("old"), F.lit(""))] if attribute in legacy.columns else []
        if attribute in defaults.columns:
            parts.append(found("default"))
        base = F.coalesce(*parts, F.lit(""))
        return F.coalesce(found("override"), base) if attribute in overrides.columns else base

    kept = [c for c in new.columns if c not in attributes]
    return patched.select(*kept, *[value(a).alias(a) for a in attributes])


def version_diff(old: DataFrame, new: DataFrame, key: str, attribute: str) -> DataFrame:
    """Ids added, removed, or present in both under another attribute value: one full join."""
    before = old.select(key, F.col(attribute).alias("old_value"), F.lit(True).alias("in_old"))
    after = new.select(key, F.col(attribute).alias("new_value"), F.lit(True).alias("in_new"))
    change = (
        F.when(F.col("in_old").isNull(), "added")
        .when(F.col("in_new").isNull(), "removed")
        .when(~F.col("old_value").eqNullSafe(F.col("new_value")), "changed")
    )
    joined = before.join(after, key, "full_outer").withColumn("change", change)
    return joined.where("change IS NOT NULL").select(key, "change", "old_value", "new_value")


def top_changes(diff: DataFrame, key: str, limit: int = 30) -> DataFrame:
    """The first changed ids in key order and one closing row with the number left out."""
    changed = diff.where(F.col("change") == "changed").select(
        F.col(key).cast("string").alias("item"), "old_value", "new_value", F.col(key).alias("_order")
    )
    # Written once: the list and the count read the rows, neither compares the versions again.
    changed = materialise(changed, fresh_path(diff.sparkSession, "changes"))
    listed = changed.orderBy("_order").limit(limit).select("item", "old_value", "new_value", F.lit(0).cast("bigint").alias("more"))
    rest = changed.agg(F.greatest(F.count(F.lit(1)) - F.lit(limit), F.lit(0)).alias("more")).select(
        F.lit("...").alias("item"), F.lit(None).cast("string").alias("old_value"),
        F.lit(None).cast("string").alias("new_value"), "more",
    )
    return listed.unionByName(rest.where("more > 0"))


def group_count(dimension: DataFrame, column: str = "route") -> DataFrame:
    return dimension.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def both_directions(bases: DataFrame, base: str = "base_id") -> DataFrame:
    """A base id stands for its northbound and its southbound gantry."""
    codes = F.array(F.concat(F.col(base), F.lit("N")), F.concat(F.col(base), F.lit("S")))
    return bases.withColumn("gantry_id", F.explode(codes))


def extract_entries(documents: DataFrame, text: str, order: Sequence[str]) -> DataFrame:
    """All ``id name`` entries of a text with their position; the text is searched once."""
    found = F.regexp_extract_all(F.col(text), F.lit(ENTRY_PATTERN), F.lit(0))
    matches = documents.select(*order, F.posexplode(found).alias("entry_pos", "entry"))
    return matches.withColumn("gantry_id", F.regexp_extract("entry", f"^{GANTRY_ID_PATTERN}", 0))


def entry_routes(documents: DataFrame, text: str, keys: Sequence[str], markers: Sequence[str]) -> DataFrame:
    """All entries with the route they stand under: the marker that opens their section, NULL before the first.

    A row's text is cut at its markers and each part searched; no text is shuffled. ``start_pos`` and ``entry_pos`` give
    the reading order.
    """
    bounds = section_bounds(documents, text, [*keys, text], markers)
    body = F.substring(F.col(text), F.col("start_pos"), F.col("end_pos") - F.col("start_pos"))
    parts = bounds.select(*keys, F.col("marker").alias("route"), "start_pos", body.alias("part"))
    found = [F.instr(F.col(text), marker) for marker in markers]
    opening = F.array_min(F.filter(F.array(*found), lambda place: place > 0))
    head = F.when(opening.isNull(), F.col(text)).otherwise(F.substring(F.col(text), F.lit(1), opening - 1))
    before = documents.select(*keys, F.lit(None).cast("string").alias("route"), F.lit(0).alias("start_pos"), head.alias("part"))
    return extract_entries(parts.unionByName(before), "part", [*keys, "route", "start_pos"])


def entry_names(entries: DataFrame) -> DataFrame:
    """The entry text replaced by the tidied name in it. Cheapest after :func:`first_seen`."""
    section = tidy_label(F.regexp_extract("entry", ENTRY_PATTERN, 2))
    return entries.withColumn("section", section).drop("entry")


def first_seen(entries: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Of each id the first entry in reading order, as a minimum that tasks take before the shuffle."""
    rest = [c for c in entries.columns if c not in (key, *order)]
    return entries.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("first")).select(key, "first.*")


def section_bounds(documents: DataFrame, text: str, keys: Sequence[str], markers: Sequence[str]) -> DataFrame:
    """Where each marked section of a text starts and ends.

    A section opens at the first place its marker stands and closes where the next one opens, or
    at the end of the text. All of it happens inside the row, so no text is shuffled.
    """
    body = F.col(text)
    starts = F.array(*[F.struct(F.instr(body, m).alias("start_pos"), F.lit(m).alias("marker")) for m in markers])
    found = documents.select(
        *keys,
        (F.length(body) + F.lit(1)).alias("text_end"),
        F.array_sort(F.filter(starts, lambda s: s["start_pos"] > 0)).alias("starts"),
    )
    bounds = F.transform(
        "starts",
        lambda s, i: F.struct(
            s["marker"].alias("marker"),
            s["start_pos"].alias("start_pos"),
            F.coalesce(F.get(F.col("starts"), i + 1)["start_pos"], F.col("text_end")).alias("end_pos"),
        ),
    )
    return found.select(*keys, F.inline(bounds))


def join_chunks(chunks: Column) -> Column:
    """``- title：text`` per chunk, one line each, in document order."""
    lines = F.transform(chunks, lambda c: F.concat(F.lit("- "), c["title"], F.lit("："), c["text"]))
    return F.array_join(lines, "\n")
