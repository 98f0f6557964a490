"""Near-duplicate lines by an exact set-similarity join; the later of two matching lines goes.

Lines are sets of five-word shingles over lower-cased words. Equal sets fold; the others are
joined by prefix: elements in the order of rarity, length and positional filters, then the sets
are compared. A line is removed if any earlier line matches it, earlier meaning a smaller
(doc_id, line number); matches needn't stay themselves. A crowded bucket of the index first compares
its lines with its earliest one, and while many are left, with the earliest one left; a line that
has found an earlier match is done. The others are compared with all earlier lines.

Lines of fewer than ``min_words`` words always stay; with ``min_words=1``, as op5 has it, a line of under
five words is one set of all its words in order and goes if an earlier line equals it. Null texts
stay null. Rows with the same id are told apart only by line number, so equal lines of repeated rows go
where the other row has them at an earlier number. Rows with a null id stay as they are. An empty
table gives an empty result. Columns other than id and text are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import simjoin
from plumbline.llm.common import stage

MIN_WORDS = 5
#: Rounds of one comparison a line and bucket before the rest is compared in full.
HUB_ROUNDS = 5
#: More lines in a bucket than this are first compared with hubs; fewer all meet.
CROWD = 16
#: 64-bit words of a line's bitmap.
WORDS = 4


def matches(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, no, of_doc, of_no): each line to remove and an earlier line that it matches; ``text_hash`` tells
    texts that share an id apart."""
    rows = simjoin.named(df, id_col, text_col).select("id", "text")
    cut = simjoin.Cut(by_line=True, least=min_words)
    sieved = simjoin.sieve(rows, cut)
    members, heads = simjoin.representatives(rows, sieved, cut, WORDS)
    prefixes = simjoin.prefix_index(heads)
    places_ = prefixes.select("key", "n", "bits", "unique", F.posexplode("prefix").alias("_at", "element")).select(
        "key", "n", "bits", (F.col("unique") + F.col("_at")).alias("at"), "element")
    met_twice = places_.groupBy("element").agg(F.count("*").alias("lines")).where("lines > 1").select("element")
    index = stage(places_.join(met_twice, "element"), "index")

    # Where a passage has many variants, in a crowded bucket, the earliest line, then the earliest of those
    # that matched none, is held against the later ones without a match: each line is compared with the
    # nearest, by bitmap, of the lines that its buckets hold against it. Few are left there, and few
    # met in the other buckets.
    open_, found, tried = index, None, None
    for turn in range(HUB_ROUNDS):
        hubs = open_.groupBy("element").agg(F.min(F.struct("key", "n", "at", "bits")).alias("hub"), F.count("*").alias("lines")).where(
            F.col("lines") > CROWD).drop("lines")
        met = stage(open_.join(hubs, "element").where("key > hub.key"), "met")
        if met.isEmpty():
            break
        near = met.where(simjoin.can_link("n", "at", "hub.n", "hub.at")).where(
            simjoin.may_link("n", "bits", "hub.n", "hub.bits", WORDS)).select(
            F.col("key").alias("b"), F.col("hub.key").alias("a"), simjoin.far("bits", "hub.bits", WORDS).alias("far"))
        if tried is not None:
            near = near.join(tried, ["a", "b"], "left_anti")
        pairs = near.groupBy("b").agg(F.min_by("a", F.struct("far", "a")).alias("a")).select("a", "b")
        done = simjoin.verified(pairs, heads, "first")
        new = done.where("linked").select("b", "a")
        found = new if found is None else found.union(new)
        tried = done.select("a", "b") if tried is None else tried.union(done.select("a", "b"))
        open_ = met.select(*index.columns).join(new.select(F.col("b").alias("key")), "key", "left_anti")
    # lines that found none, with all earlier ones
    left = index if found is None else index.join(found.select(F.col("b").alias("key")), "key", "left_anti")
    l, r = index.alias("l"), left.alias("r")
    rest = l.join(r, F.expr("l.element = r.element AND l.key < r.key") & simjoin.can_link("l.n", "l.at", "r.n", "r.at")
                  & simjoin.may_link("l.n", "l.bits", "r.n", "r.bits", WORDS)).select(
        F.col("l.key").alias("a"), F.col("r.key").alias("b")).distinct()
    more = simjoin.verified(rest if tried is None else rest.join(tried, ["a", "b"], "left_anti"), heads, "more")
    last = more.where("linked").groupBy("b").agg(F.min("a").alias("a")).select("b", "a")
    found = last if found is None else found.union(last)

    near = members.join(found.withColumnRenamed("b", "head"), "head", "left").select(
        "key", F.when(F.col("key") > F.col("head"), F.col("head")).otherwise(F.col("a")).alias("of")).where("of IS NOT NULL")
    places = members.select("key", "id", "no")
    return stage(
        near.join(places, "key").select(F.col("id.id").alias("doc_id"), F.col("id.hash").alias("text_hash"), "no", "of")
        .join(places.select(F.col("key").alias("of"), F.col("id.id").alias("of_doc"), F.col("no").alias("of_no")), "of")
        .drop("of"), "lines")


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``df`` with its text less the lines to remove, and ``removed_lines``, their numbers in order.

    A column of that name in ``df`` is replaced; all others stay, whatever their names.
    """
    gone = matches(df, id_col, text_col, min_words).groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set("no")).alias("gone"))
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("hash"))
    marked = rows.join(gone, (F.col("id") == F.col("doc_id")) & (F.col("hash") == F.col("text_hash")), "left")
    text = F.col("row").getField(text_col)
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda s, i: ~F.array_contains("gone", i)), "\n")
    return marked.select(
        *[(F.when(F.col("gone").isNull(), text).otherwise(kept) if c == text_col else F.col("row").getField(c)).alias(c)
          for c in df.columns if c != "removed_lines"],
        F.coalesce("gone", F.array().cast("array<int>")).alias("removed_lines"))
