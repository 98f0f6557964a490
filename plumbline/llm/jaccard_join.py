"""Near-duplicate documents by a grouped prefix join on word shingles.

After the sieve, equal sets fold into one head. Heads with the same size and the same prefix form
a group; only groups meet in the index of prefix elements, where length and positional filters
reject pairs of groups; what is left is expanded to members and verified one by one.

Links matter only as far as they connect. Each crowded bucket of the index has a hub; a group is compared
with the nearest of its buckets' hubs, by the distance of bitmaps, which is never above that of the
sets, so that too far a pair is rejected unread. Members that are connected by then need no further
comparison with each other, and a bucket whose members are all connected is done. After a few rounds
whatever remains unconnected meets in full, bitmaps first, so no link between different components
is lost, while a family of thousands of near copies takes a comparison for each member and round
and not one for each pair.

Null and empty texts and texts without words have an empty set and link with nothing. Rows with
the same id are one node. A row with a null id keeps its size and gets a null component. An empty
table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import simjoin
from plumbline.llm.common import stage

HUB_ROUNDS = 4
#: A bucket of more members than this has a hub; the members of others all meet.
CROWD = 16
#: 64-bit words of a text's bitmap.
WORDS = 8

CUT = simjoin.Cut(by_line=False)


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node that each node of ``edges`` (a, b) is connected with.

    Labels fall to the smallest of the neighbours' labels and then jump to their label's label;
    every round is a written table.
    """
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("comp")), "labels")
    while True:
        seen = both.join(labels.withColumnsRenamed({"node": "b", "comp": "other"}), "b").groupBy("a").agg(F.min("other").alias("other"))
        lower = labels.join(seen.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("comp").alias("was"), F.least("comp", "other").alias("comp"))
        jump = lower.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
        after = stage(
            lower.join(jump, "comp", "left")
            .select("node", "was", F.least("comp", F.coalesce("next", "comp")).alias("comp")), "labels")
        changed = after.where("was <> comp").limit(1).count()
        labels = after.select("node", "comp")
        if not changed:
            return labels


def _buckets(index: DataFrame, groups: DataFrame, comps: DataFrame, hubs: bool) -> DataFrame:
    """The index with each group's components, of those buckets that aren't all connected yet; with their hubs if asked for."""
    state = groups.join(comps, "key").groupBy("group").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min_by(F.struct("key", "comp", "bits"), "key").alias("first"))
    rows = index.join(state, "group")
    if not hubs:
        rows = rows.select("element", "group", "n", "at", "members", "lo", "hi", F.col("first.bits").alias("bits"))
    ends = [f(F.struct("unique", "first", "n", "at", "group")).alias(c) for f, c in ((F.min, "hub"), (F.max, "hub2"))] if hubs else []
    open_ = rows.groupBy("element").agg(F.min("lo").alias("least"), F.max("hi").alias("most"), *ends).where(
        "least < most").drop("least", "most")
    return stage(rows.join(open_, "element"), "buckets")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row."""
    rows = simjoin.named(df, id_col, text_col).select("id", "text")
    sieved = stage(simjoin.sieve(rows, CUT), "sieved")
    members, heads = simjoin.representatives(rows, sieved, CUT, WORDS)
    prefixes = simjoin.prefix_index(heads)

    # groups: same size, same prefix; a set with elements of its own in the prefix is alone
    alone = F.when(F.col("unique") > 0, F.col("key"))
    grouped = prefixes.withColumn("name", F.md5(F.concat_ws(",", "n", F.coalesce(alone, F.lit(-1)), F.concat_ws(",", F.col("prefix").cast("array<string>")))))
    groups = stage(grouped.select(F.col("name").alias("group"), "key", "n", "unique", "prefix", "bits"), "groups")
    index = stage(
        groups.groupBy("group").agg(F.count("*").alias("members"), *[F.first(c).alias(c) for c in ("n", "unique", "prefix")])
        .select("group", "n", "unique", "members", F.posexplode("prefix").alias("_at", "element"))
        .select("group", "n", "unique", "members", (F.col("unique") + F.col("_at")).alias("at"), "element"), "index")
    groups = groups.select("group", "key", "n", "bits")
    crowds = index.groupBy("element").agg(F.sum("members").alias("c")).where(F.col("c") > CROWD).select("element")
    crowded = stage(index.join(crowds, "element"), "crowded")

    comps = groups.select("key", F.col("key").alias("comp"))
    tried, whole = None, False
    for turn in range(HUB_ROUNDS + 1):
        whole = whole or turn == HUB_ROUNDS
        if not whole:
            rows_ = _buckets(crowded, groups, comps, True)
            whole = rows_.isEmpty()  # all that share a crowded bucket are connected
        if whole:
            rows_ = _buckets(index, groups, comps, False)
            if rows_.isEmpty():  # all that share a bucket are connected
                break
        hub = "hub" if turn % 2 == 0 else "hub2"
        own = groups.join(comps, "key")
        if not whole:
            # of all hubs in its buckets, a group meets the nearest one by bitmap
            met = rows_.where(f"NOT (lo = hi AND lo = {hub}.first.comp)").where(
                simjoin.can_link("n", "at", f"{hub}.n", f"{hub}.at")).where(
                (F.col("members") > 1) | simjoin.may_link("n", "first.bits", f"{hub}.n", f"{hub}.first.bits", WORDS)).select(
                "group", F.struct(
                    simjoin.far("first.bits", f"{hub}.first.bits", WORDS).alias("far"),
                    F.col(f"{hub}.first.key").alias("x"), F.col(f"{hub}.first.comp").alias("cx")).alias("nearest"))
            if tried is not None:  # pairs that were compared before leave the choice to others
                before = tried.select(F.col("a").alias("x"), F.col("b").alias("y")).union(tried.select("b", "a"))
                gone = before.join(groups.select(F.col("key").alias("y"), "group"), "y").select("group", "x").distinct()
                met = met.withColumn("x", F.col("nearest.x")).join(gone, ["group", "x"], "left_anti")
            met = met.groupBy("group").agg(F.min("nearest").alias("nearest")).select("group", "nearest.x", "nearest.cx")
            pairs = met.join(own, "group").where("cx <> comp").select("x", F.col("key").alias("y"))
        else:
            sizes = rows_.groupBy("element", "lo").agg(F.count("*").alias("c")).groupBy("element").agg(
                F.max(F.struct("c", "lo"))["lo"].alias("main"))
            rows_ = stage(rows_.join(sizes, "element").withColumn("in_main", F.expr("lo = hi AND lo = main")).select(
                "element", "group", "n", "at", "lo", "hi", "in_main", "members", "bits"), "rest")
            l, r = rows_.where("NOT in_main").alias("l"), rows_.alias("r")
            met = l.join(r, F.expr(
                "l.element = r.element AND (r.in_main OR l.group <= r.group) AND NOT (l.lo = l.hi AND r.lo = r.hi AND l.lo = r.lo)"
            ) & simjoin.can_link("l.n", "l.at", "r.n", "r.at") & (
                F.expr("l.members > 1 OR r.members > 1") | simjoin.may_link("l.n", "l.bits", "r.n", "r.bits", WORDS))
            ).select(F.col("l.group").alias("group"), F.col("r.group").alias("other")).distinct()
            one = own.withColumnsRenamed({"key": "x", "comp": "cx", "n": "nx", "bits": "bx"})
            two = own.withColumnRenamed("group", "other")
            pairs = met.join(one, "group").join(two, "other").where("cx <> comp").where(
                simjoin.may_link("nx", "bx", "n", "bits", WORDS)).select("x", F.col("key").alias("y"))
        pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        done = simjoin.verified(pairs, heads, "verified")
        tried = done.select("a", "b") if tried is None else tried.union(done.select("a", "b"))
        if done.where("linked").isEmpty():  # hubs bring no more
            if whole:
                break
            whole = True
            continue
        # contract: links between components join them
        ends = done.where("linked").join(comps.withColumnsRenamed({"key": "a", "comp": "ca"}), "a").join(
            comps.withColumnsRenamed({"key": "b", "comp": "cb"}), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        merged = components(ends).select(F.col("node").alias("comp"), F.col("comp").alias("into"))
        comps = stage(comps.join(merged, "comp", "left").select("key", F.coalesce("into", "comp").alias("comp")), "comps")
        if whole:
            break

    # back to documents: key -> head -> component, named by its smallest document
    ids = members.join(comps.withColumnsRenamed({"key": "head"}), "head", "left").select(
        F.col("id.id").alias("id"), F.coalesce("comp", "head").alias("comp"))
    # rows that share an id are one node: their components are joined
    twice = ids.groupBy("id").agg(F.min("comp").alias("a"), F.max("comp").alias("b"))
    across = components(twice.where("a < b").select("a", "b")).select(F.col("node").alias("comp"), F.col("comp").alias("into"))
    ids = stage(ids.join(across, "comp", "left").select("id", F.coalesce("into", "comp").alias("comp")).distinct(), "ids")
    names = ids.groupBy("comp").agg(F.min("id").alias("component_id"))
    named = ids.join(names, "comp").select("id", "component_id").distinct()
    return sieved.withColumn("id", F.col("id.id")).join(named, "id", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"))
