"""How filters overlap: what each takes away after any others have run.

One table of failing ids is kept per filter. A failing row starts with the empty set of others
before it; then the tables are gone through one by one. The left-anti join with a table gives the
rows that its filter would have let through to them: each of their sets now also stands with that
filter added. The left-semi join gives the rows it takes away first; their sets stay as they are.
After the last table a row holds exactly those sets of other filters after which its own filter
still removes it, so one aggregate gives the removals and label losses of all 80 pairs of a filter
and a set of others. Every step of the 120 orders is one of these pairs. Rows that pass every
filter never leave their scan, and a row is shuffled once a table.

Filters, on words split at the six ASCII white-space characters:

====== =======================================================================
filter a document fails if
====== =======================================================================
A      it has under 50 words
B      under 65 % of its words are distinct
C      over 5 % of its code points are A-Z
D      it holds one of ``#$%&*|``
E      a document with a smaller id has the same text
====== =======================================================================
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import stored

FILTERS = "ABCDE"
LEAST_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
SYMBOLS = "#$%&*|"
#: What the joins compare: the id and a hash of the text, so that rows sharing an id stay apart.
KEY = ["id", "tie"]


def text_measures(text: Column) -> Column:
    """Words, distinct words, capitals and code points of a text; it is split into words once."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    counted = F.transform(F.array(words), lambda w: F.struct(
        F.size(w).cast("long").alias("words"), F.size(F.array_distinct(w)).cast("long").alias("distinct_words")))
    return F.struct(
        F.get(counted, 0).alias("of"), F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long").alias("capitals"),
        F.length(text).cast("long").alias("points"))


def marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One narrow row per document: part, key, digest of the text, labels and text filters.

    The only pass over the texts; the rows are written once.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.coalesce("source", F.lit("")).alias("part"),
        F.col("doc_id").isNull().alias("unnumbered"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(text, F.col("doc_id").isNull()).alias("tie"),
        F.unhex(F.md5(text.cast("binary"))).alias("digest"),
        text_measures(text).alias("measures"),
        reduce(Column.__or__, [F.contains(text, F.lit(c)) for c in SYMBOLS]).alias("D"),
    )
    of = lambda name: F.col(f"measures.{name}")
    rows = rows.select(
        "*",
        (of("of.words") < LEAST_WORDS).alias("A"),
        (of("of.distinct_words") * 100 < of("of.words") * DISTINCT_PERCENT).alias("B"),
        (of("capitals") * 100 > of("points") * CAPITAL_PERCENT).alias("C"),
    ).drop("measures")
    # An id labelled twice counts as good or toxic if any of its rows says so.
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    joined = rows.join(known, (rows.id == known.labelled) & ~rows.unnumbered, "left")
    flag = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("good", "toxic")]
    return stored(joined.select(*rows.columns, *flag), "marked")


def failing_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """Per filter the documents that fail it: key, part, good, toxic.

    For E the smallest id of each text is taken by a plain aggregate, so a text copied across a
    third of the table shrinks before the shuffle; all other rows with an id fail.
    """
    columns = [*KEY, "part", "good", "toxic"]
    tables = {f: rows.where(f).select(*columns) for f in FILTERS[:-1]}
    numbered = rows.where("NOT unnumbered")
    first = numbered.groupBy("digest").agg(F.min("id").alias("id"), F.min("tie").alias("tie")).select(*KEY)
    tables["E"] = numbered.join(first, KEY, "left_anti").select(*columns)
    return {f: stored(t, f"failing-{f}") for f, t in tables.items()}


def removals(tables: dict[str, DataFrame]) -> DataFrame:
    """(part, prefix, filter, removed, good_lost, toxic_lost) for every filter and set of others.

    ``prefix`` names the others in alphabetical order. Pairs that remove nothing are left out.
    """
    none = F.array(F.lit(""))
    rows = reduce(DataFrame.unionAll, [
        t.select("*", F.lit(f).alias("filter"), none.alias("prefixes")) for f, t in tables.items()])
    for name, table in tables.items():
        keys = table.select(*KEY)
        others = rows.where(F.col("filter") != name)
        added = F.concat("prefixes", F.transform("prefixes", lambda p: F.concat(p, F.lit(name))))
        passed = others.join(keys, KEY, "left_anti").withColumn("prefixes", added)
        taken = others.join(keys, KEY, "left_semi")
        own = rows.where(F.col("filter") == name)
        rows = stored(reduce(DataFrame.unionByName, [passed, taken, own]), "failing")
    return rows.select("part", "filter", "good", "toxic", F.explode("prefixes").alias("prefix")).groupBy(
        "part", "prefix", "filter").agg(
        F.count("*").alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost"))


def orders() -> list[tuple[str, int, str, str, int]]:
    """(order, step, prefix, filter, weight) of every step of every order.

    ``weight``: in how many orders the filter comes right after these others, in any arrangement.
    """
    rows = []
    for order in permutations(FILTERS):
        for at, name in enumerate(order):
            prefix = "".join(sorted(order[:at]))
            rows.append(("".join(order), at + 1, prefix, name, factorial(at) * factorial(len(FILTERS) - 1 - at)))
    return rows


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per source, order of the filters and step: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost and shapley, zeros included.

    Null texts are empty texts, and those fail A alone of the text filters; a null source is the
    part ''. A document without an id never fails E nor makes another fail, and has no labels.
    Repeated rows count each; those that share id and text are not copies of a smaller id. An
    empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = marked(docs, labels)
    counts = removals(failing_tables(rows))
    steps = spark.createDataFrame(orders(), "filter_order string, step int, prefix string, filter string, weight long")
    cells = sorted({(prefix, name, weight) for _, _, prefix, name, weight in orders()})  # 80 of them
    each = F.array(*[F.struct(F.lit(p).alias("prefix"), F.lit(n).alias("filter"), F.lit(w).alias("weight"))
                     for p, n, w in cells])
    sizes = rows.groupBy("part").agg(F.count("*").alias("size"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("removed", "good_lost", "toxic_lost")]
    full = sizes.select("part", "size", F.explode(each).alias("cell")).select("part", "size", "cell.*").join(
        counts, ["part", "prefix", "filter"], "left").select("part", "size", "prefix", "filter", "weight", *zero)
    own = Window.partitionBy("part", "filter")  # 16 rows
    others = F.length("prefix")
    told = full.select(
        "*",
        F.max(F.when(others == 0, F.col("removed"))).over(own).alias("fails"),
        F.max(F.when(others == len(FILTERS) - 1, F.col("removed"))).over(own).alias("unique_fails"),
        F.sum(F.col("removed") * F.col("weight")).over(own).alias("shapley"),
    ).drop("weight")
    so_far = Window.partitionBy("part", "filter_order").orderBy("step")  # 5 rows
    return told.join(F.broadcast(steps.drop("weight")), ["prefix", "filter"]).select(
        "part", "filter_order", "step",
        (F.col("size") - F.sum("removed").over(so_far)).alias("kept"),
        "removed", (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails", "good_lost", "toxic_lost", "shapley")
