"""Personal data by fixed forms, and by contexts learned from what the fixed forms find.

Every text is read once: the four fixed forms give its base spans, and every token with a digit or an @ is a mention
with the words before it. The base spans' identifiers are the seeds. A pattern is one word or two before a mention;
patterns and identifiers form a graph. In turns, patterns are scored by the share of known identifiers among all that
stand behind them, and unknown identifiers of a looser form by the mean score of their patterns; the best become
known. Mentions of identifiers found so, behind a pattern of high score, are added to the base spans.

Text expressions stay inside Spark's functions, and joins move identifiers and patterns, never texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gantrylake.llm.rows import quoted, unpacked
from gantrylake.llm.scratch import Scratch

KINDS = ["email", "ip", "card", "phone"]

# --- fixed forms. A run of characters is tried from its begin only and never given back, so that
# --- long runs cost linear time; what they match is what the plain forms match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A token with a digit or an @, and groups of digits that follow it.
MENTION = r"(?<![A-Za-z0-9_%+.@()-])[A-Za-z_%+.()-]*+[0-9@][A-Za-z0-9_%+.@()-]*+(?: [(]?[0-9][0-9().-]*+)*+"
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: What an identifier of a kind may look like where its context vouches for it.
LOOSE = {
    "email": r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]*[A-Za-z0-9]$",
    "ip": rf"^{PART}(?:[.-]{PART}){{3}}$",
    "card": r"^[0-9](?:[ .-]?[0-9]){11,18}$",
    "phone": r"^\+?[(]?[0-9][ ().0-9-]*[0-9]$",
}
#: Characters of the text before a mention among which its words are looked for.
BEFORE = 48


@dataclass(frozen=True)
class Bootstrap:
    """When a pattern vouches for a kind, and when an identifier becomes known."""

    support: int = 5
    precision: float = 0.8
    mean: float = 0.5
    rounds: int = 4


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def luhn(number: Column) -> Column:
    """True for at most 19 digits whose Luhn sum ends in 0."""
    padded = F.lpad(number, 19, "0")
    plain = [F.substring(padded, n, 1).cast("int") for n in range(19, 0, -2)]
    doubled = [F.translate(F.substring(padded, n, 1), "0123456789", "0246813579").cast("int") for n in range(18, 0, -2)]
    return reduce(lambda a, b: a + b, plain + doubled) % 10 == 0


def sound(kind: str, hit: Column) -> Column:
    """Whether what the base form matched counts."""
    if kind == "ip":
        return hit.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        number = F.translate(hit, " -", "")
        return F.length(number).between(16, 19) & luhn(number)
    if kind == "phone":
        return F.length(digits(hit)).between(8, 15)
    return F.lit(True)


def vouchable(kind: str, core: Column) -> Column:
    """Whether an identifier may be of the kind if its contexts say so."""
    formed = core.rlike(LOOSE[kind])
    if kind == "card":
        return formed & luhn(digits(core))
    if kind == "phone":
        return formed & F.length(digits(core)).between(7, 15)
    return formed


def identifier(surface: Column) -> Column:
    """Letters, digits and @ of a surface, in lower case."""
    return F.lower(F.regexp_replace(surface, "[^A-Za-z0-9@]+", ""))


def split_up(text: Column, form: str) -> tuple[Column, Column]:
    """The text between matches and the matches; zipped, so that neither is worked out again for every match."""
    return F.split(text, form, -1), F.regexp_extract_all(text, F.lit(form), F.lit(0))


def base_spans(kind: str, zipped: Column) -> Column:
    """(kind, start, end, hit) of the sound matches, in code points; ``zipped`` pairs ``gap`` and ``hit``.

    Places are gathered as text: an array would be copied, span by span, each time that one is added.
    """

    def step(done: Column, one: Column) -> Column:
        start = done["at"] + F.length(one["gap"])
        end = start + F.coalesce(F.length(one["hit"]), F.lit(0))
        place = F.concat(done["places"], F.lit(";"), start.cast("string"), F.lit(":"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(counts(one), place).otherwise(done["places"]).alias("places"))

    def counts(one: Column) -> Column:
        return one["hit"].isNotNull() & sound(kind, one["hit"])

    def span(one: Column) -> Column:
        ends = [F.substring_index(one["place"], ":", side).cast("int") for side in (1, -1)]
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), ends[0].alias("start"), ends[1].alias("end"), one["hit"].alias("hit"))

    places = F.aggregate(zipped, F.struct(F.lit(0).alias("at"), F.lit("").alias("places")), step)["places"]
    listed = F.array_remove(F.split(places, ";"), "")
    both = F.arrays_zip(listed, F.filter(zipped, counts)["hit"]).cast("array<struct<place:string,hit:string>>")
    return F.transform(both, span)


def mentions(zipped: Column) -> Column:
    """(surface, gap, before) of every mention; ``gap`` is the length of the text between it and the one before."""

    def mention(one: Column) -> Column:
        before = F.lower(F.right(one["gap"], F.lit(BEFORE)))
        return F.struct(one["hit"].alias("surface"), F.length(one["gap"]).alias("gap"), before.alias("before"))

    return F.transform(F.filter(zipped, lambda one: one["hit"].isNotNull()), mention)


def patterns(before: Column) -> Column:
    """The word and the two words that end in front of a mention, with the signs between."""
    blank = F.regexp_replace(before, r"\s+", " ")
    found = [F.regexp_extract(blank, rf"(?:\p{{L}}+[^\p{{L}}]{{1,6}}){{{n}}}$", 0) for n in (1, 2)]
    return F.filter(F.array(*found), lambda found: found != "")


def shown(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda one: F.concat_ws(":", F.get(names, one["kind"]), one["start"], one["end"])), ",")


def read_texts(docs: DataFrame, text_col: str, carry: list[str], scratch: Scratch) -> DataFrame:
    """``row``, ``at`` (a number of its own per row), ``base`` spans and ``mentions``."""
    row = F.struct(*[quoted(name) for name in carry]).alias("row")
    texts = docs.select(row, F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"))
    parts = {}
    for name, form in [*BASE.items(), ("mentions", MENTION)]:
        gap, hit = split_up(F.col("text"), form)
        parts |= {f"{name}_gap": gap, f"{name}_hit": hit}
    found = texts.select("row", F.monotonically_increasing_id().alias("at"), *[part.alias(name) for name, part in parts.items()])

    def zipped(name: str) -> Column:
        return F.arrays_zip(f"{name}_gap", f"{name}_hit").cast("array<struct<gap:string,hit:string>>")

    base = [base_spans(kind, zipped(kind)) for kind in KINDS]
    return scratch.write(found.select("row", "at", F.concat(*base).alias("base"), mentions(zipped("mentions")).alias("mentions")), "texts")


def mention_rows(texts: DataFrame) -> DataFrame:
    """One row per mention: ``at``, ``n``, ``gap``, ``surface``, ``core`` without signs around it, ``instance``, ``patterns``."""
    each = texts.select("at", F.posexplode("mentions").alias("n", "mention")).select("at", "n", "mention.*")
    core = F.rtrim(F.ltrim("surface", F.lit(".)_%-")), F.lit(".()_%+-"))
    return each.select("at", "n", "gap", "surface", core.alias("core"), identifier(core).alias("instance"), patterns(F.col("before")).alias("patterns"))


def graph(each: DataFrame) -> DataFrame:
    """Edges between patterns and identifiers, once each, with the kinds that the identifier's looks allow."""
    allowed = F.array_compact(F.array(*[F.when(vouchable(kind, F.col("core")), F.lit(n)) for n, kind in enumerate(KINDS)]))
    edges = each.where("instance != ''").select(F.explode("patterns").alias("pattern"), "instance", allowed.alias("allowed"))
    return edges.groupBy("pattern", "instance").agg(F.array_distinct(F.flatten(F.collect_set("allowed"))).alias("allowed"))


def scored_patterns(edges: DataFrame, known: DataFrame) -> DataFrame:
    """(pattern, scores): for each kind the share of its known identifiers behind the pattern, and their number."""
    labelled = edges.join(known, "instance", "left")
    counts = [F.count(F.when(F.col("kind") == n, 1)).alias(f"k{n}") for n in range(len(KINDS))]
    totals = labelled.groupBy("pattern").agg(F.count(F.lit(1)).alias("total"), *counts)
    per_kind = [F.struct(F.lit(n).alias("kind"), F.col(f"k{n}").alias("support"), (F.col(f"k{n}") / F.col("total")).alias("precision")) for n in range(len(KINDS))]
    return totals.select("pattern", F.explode(F.array(*per_kind)).alias("score")).select("pattern", "score.*").where("support > 0")


def trusted(scores: DataFrame, rule: Bootstrap) -> DataFrame:
    return scores.where((F.col("support") >= rule.support) & (F.col("precision") >= rule.precision))


def discovered(edges: DataFrame, scores: DataFrame, known: DataFrame, rule: Bootstrap) -> DataFrame:
    """(instance, kind) of unknown identifiers whose patterns speak for one kind.

    At least one pattern is trusted, and the mean over all patterns of the identifier reaches the rule's.
    """
    good = trusted(scores, rule).select("pattern").distinct()
    near = edges.join(good, "pattern", "left_semi").select("instance").distinct().join(known, "instance", "left_anti")
    open_ = edges.join(near, "instance", "left_semi").where(F.size("allowed") > 0)
    degree = open_.groupBy("instance").agg(F.count(F.lit(1)).alias("degree"))
    fits = F.array_contains("allowed", F.col("kind"))
    firm = (F.col("support") >= rule.support) & (F.col("precision") >= rule.precision)
    spoken = open_.join(scores, "pattern").where(fits).groupBy("instance", "kind").agg(F.sum("precision").alias("sum"), F.max(firm).alias("firm"))
    ranked = spoken.join(degree, "instance").withColumn("mean", F.col("sum") / F.col("degree")).where(F.col("firm") & (F.col("mean") >= rule.mean))
    best = ranked.groupBy("instance").agg(F.max(F.struct("mean", (-F.col("kind")).alias("first"))).alias("best"))
    return best.select("instance", (-F.col("best.first")).alias("kind"))


def bootstrap(edges: DataFrame, seeds: DataFrame, rule: Bootstrap, scratch: Scratch) -> tuple[DataFrame, DataFrame] | None:
    """(identifiers found, trusted patterns) after the last round that found any, or None."""
    known, found, good = seeds, [], None
    for _ in range(rule.rounds):
        scores = scratch.write(scored_patterns(edges, known), "scores")
        new = scratch.write(discovered(edges, scores, known, rule), "found")
        if not new.limit(1).count():
            break
        found.append(new)
        good = trusted(scores, rule).select("pattern", "kind")
        known = scratch.write(known.unionByName(new), "known")
    return (reduce(DataFrame.unionByName, found), good) if found else None


def added_spans(each: DataFrame, texts: DataFrame, found: DataFrame, good: DataFrame) -> DataFrame:
    """(at, more): spans of mentions of found identifiers behind a trusted pattern of their kind, off every base span."""
    named = each.join(found, "instance").select("at", "n", "kind", F.explode("patterns").alias("pattern"))
    behind = named.join(good, ["pattern", "kind"], "left_semi").select("at", "n", "kind").distinct()
    run = Window.partitionBy("at").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lead = F.length("surface") - F.length(F.ltrim("surface", F.lit(".)_%-")))
    # Only mentions of texts that gain a span are laid end to end.
    ends = each.join(behind.select("at").distinct(), "at", "left_semi").withColumn("stop", F.sum(F.col("gap") + F.length("surface")).over(run).cast("int"))
    start = F.col("stop") - F.length("surface") + lead
    placed = ends.join(behind, ["at", "n"]).select("at", F.struct("kind", start.alias("start"), (start + F.length("core")).alias("end")).alias("span"))
    rows = placed.groupBy("at").agg(F.collect_list("span").alias("spans")).join(texts.select("at", "base"), "at")
    free = F.filter("spans", lambda one: ~F.exists("base", lambda base: (base["start"] < one["end"]) & (one["start"] < base["end"])))
    return rows.select("at", free.alias("more"))


def find_personal(
    docs: DataFrame,
    text_col: str = "text",
    carry: list[str] | None = None,
    rule: Bootstrap = Bootstrap(),
    seeds: DataFrame | None = None,
) -> DataFrame:
    """The carried columns, ``base`` and ``spans``: arrays of (kind, start, end) by kind (see ``KINDS``), then start.

    Base spans are the sound matches of the fixed forms; ``spans`` holds them and what the contexts add. ``seeds``
    (kind by name, surface) names identifiers known beforehand. An identifier seen as two kinds has the first. Spans are in code
    points, ends exclusive. NULL and empty texts have none. Repeated rows are judged each, and count once as
    evidence: edges hold distinct identifiers. Texts of any length are read whole. An empty table gives no rows.
    """
    spark = docs.sparkSession
    carry = carry or ["doc_id"]
    scratch = Scratch(spark, "personal")
    texts = read_texts(docs, text_col, carry, scratch)
    own = texts.select(F.explode("base").alias("span")).select("span.kind", identifier(F.col("span.hit")).alias("instance"))
    if seeds is not None:
        number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
        own = own.unionByName(seeds.select(number.alias("kind"), identifier(F.col("surface")).alias("instance")).where("kind >= 0"))
    known = scratch.write(own.where("instance != ''").groupBy("instance").agg(F.min("kind").alias("kind")), "seeds")
    each = scratch.write(mention_rows(texts), "mentions")
    edges = scratch.write(graph(each), "edges")
    result = bootstrap(edges, known, rule, scratch)
    bare = F.transform("base", lambda one: F.struct(one["kind"].alias("kind"), one["start"].alias("start"), one["end"].alias("end")))
    if result is None:
        full = texts.select("row", bare.alias("base"), bare.alias("spans"))
    else:
        more = added_spans(each, texts, *result)
        both = F.when(F.col("more").isNull(), bare).otherwise(F.array_sort(F.concat(bare, F.col("more"))))
        full = texts.join(more, "at", "left").select("row", bare.alias("base"), both.alias("spans"))
    return scratch.finish(unpacked(full, carry, "base", "spans"))


def count_of(kind: str, spans: str = "base") -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda one: one["kind"] == number)).cast("long")
