"""Benchmark decontamination by a positional inverted index, in DataFrame functions.

A window is 10 consecutive words of a benchmark item (a shorter item is one
window). Term frequencies of the whole corpus tell the rarest terms of each
window: its anchors. The index stores postings (document, position) of the anchor
terms. A posting list is adjusted by the anchor's place in the item, so that equal
values mean the same alignment of document and item; lists of a window's anchors
are intersected as bits of one number, and alignments that all anchors of some window
share are checked word by word against the document. Anchors 64 words apart have the
same bit: that lets more alignments through to the check, and loses none.

The corpus is read in narrow passes: tokens are counted with map-side combine,
postings exist for anchors only, and texts are joined to the documents that have
an alignment left. Benchmark-sided tables are joined as written tables of known
size: the planner sends small ones to all tasks, and shuffles and splits others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from topicmill.llm.common import ascii_lower, row_key, shielded
from topicmill.session import stage

# What separates words, and the length of a window.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same for texts in which A-Z are not in lower case yet.
NO_WORD_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
ANCHORS = 3
# Alignments (some 100 bytes each) up to which their documents are found by a
# broadcast join.
SENT_ALIGNMENTS = 400_000

KEY = ["_k1", "_k2"]


def words(text: Column) -> Column:
    """Words of a text, A-Z in lower case; null has none."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD)
    # Only the ends of a split can be empty.
    return F.array_remove(parts, "")


def word_count(text: Column) -> Column:
    """How many words a text has; their case doesn't matter for that."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), NO_WORD_ANY_CASE), ""))


def _items(benchmark: DataFrame, window: int) -> DataFrame:
    """(item, item_id, item_words, width) of items that have words.

    `item` tells texts of one id apart; a null id counts as an empty one.
    """
    item_id = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    rows = benchmark.select(item_id.alias("item_id"), words(F.col("text")).alias("item_words")).where(F.size("item_words") > 0)
    keyed = rows.dropDuplicates().withColumn("item", F.xxhash64("item_id", "item_words"))
    return keyed.withColumn("width", F.least(F.lit(window), F.size("item_words")))


def _tokens(docs: DataFrame) -> DataFrame:
    return docs.select(*KEY, F.posexplode(words(F.col("text"))).alias("pos", "term"))


def term_frequencies(docs: DataFrame) -> DataFrame:
    """(term, tf) over whole texts."""
    return docs.select(F.explode(words(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("tf"))


def _anchors(items: DataFrame, docs: DataFrame, anchors: int) -> DataFrame:
    """(item, start, place, term): the rarest terms of each window of an item.

    Terms that the corpus lacks have frequency 0 and exclude their windows.
    """
    starts = F.sequence(F.lit(0), F.size("item_words") - F.col("width"))
    windows = items.select("item", "width", "item_words", F.explode(starts).alias("start"))
    terms = windows.select(
        "item", "start", F.posexplode(F.expr("slice(item_words, start + 1, width)")).alias("offset", "term")
    ).withColumn("place", F.col("start") + F.col("offset"))
    # The corpus is counted only for terms of the benchmark; counts of one task
    # are added up before they are shuffled.
    vocabulary = stage(terms.select("term").distinct(), "bench_terms")
    counted = docs.select(F.explode(words(F.col("text"))).alias("term")).join(vocabulary, "term", "left_semi")
    tf = stage(counted.groupBy("term").agg(F.count("*").alias("tf")), "bench_tf")
    ranked = terms.join(tf, "term")
    by_window = Window.partitionBy("item", "start")
    first_of_term = F.row_number().over(Window.partitionBy("item", "start", "term").orderBy("place"))
    ranked = (
        ranked.withColumn("_found", F.count("*").over(by_window))
        .withColumn("_first", first_of_term)
        .join(items.select("item", "width"), "item")
        .where("_found = width and _first = 1")
        .withColumn("_rank", F.row_number().over(by_window.orderBy("tf", "place")))
        .where(F.col("_rank") <= anchors)
    )
    return stage(ranked.select("item", "start", "place", "term"), "bench_anchors")


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The index: (document key, pos, term) of the given terms."""
    return _tokens(docs).join(terms.select("term").distinct(), "term", "left_semi")


def _alignments(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """(document key, item, shift) where all anchors of some window agree, and maybe more."""
    bit = F.expr("shiftleft(1L, place % 64)")
    places = stage(anchors.select("item", "place", "term", bit.alias("bit")).distinct(), "bench_places")
    shifted = _tokens(docs).join(places, "term").select(*KEY, "item", (F.col("pos") - F.col("place")).alias("shift"), "bit")
    met = shifted.groupBy(*KEY, "item", "shift").agg(F.bit_or("bit").alias("met"))
    wanted = anchors.groupBy("item", "start").agg(F.bit_or(bit).alias("need"))
    # Windows are bounded by the item. Most alignments have fewer bits than any of them.
    wanted = wanted.groupBy("item").agg(F.collect_set("need").alias("needs"), F.min(F.bit_count("need")).alias("fewest"))
    wanted = stage(wanted, "bench_needs")
    whole = F.exists("needs", lambda n: n.bitwiseAND(F.col("met")) == n)
    return met.join(wanted, "item").where(F.bit_count("met") >= F.col("fewest")).where(whole).select(*KEY, "item", "shift")


def phrase_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, anchors: int = ANCHORS) -> DataFrame:
    """(document key, item_id, width, starts): exact occurrences of windows.

    `starts` are word positions in the document; an alignment gives one row.
    `docs` holds the key columns and text.
    """
    items = stage(_items(benchmark, window), "bench_items")
    found = stage(_alignments(docs, _anchors(items, docs, anchors)), "alignments")
    # One row per document; its alignments are bounded by its words and the items.
    per_doc = found.groupBy(*KEY).agg(F.collect_list(F.struct("item", "shift")).alias("_found"))
    # Few documents have an alignment. Sent to all tasks up to a checked number,
    # they spare the shuffle of all texts; more are joined by a shuffle.
    if found.count() <= SENT_ALIGNMENTS:
        per_doc = F.broadcast(per_doc)
    texts = docs.join(per_doc, KEY).select(*KEY, "_found", words(F.col("text")).alias("_words"))
    last = F.size("item_words") - F.col("width")
    # Only the words along an alignment leave the document's row: as many as the
    # longest item has.
    longest = items.agg(F.coalesce(F.max(F.size("item_words")), F.lit(0))).first()[0]
    cut = F.transform(
        "_found",
        lambda a: F.struct(
            a["item"].alias("item"),
            a["shift"].alias("shift"),
            F.slice("_words", F.greatest(a["shift"], F.lit(0)) + 1, F.lit(longest)).alias("along"),
        ),
    )
    rows = texts.select(*KEY, F.explode(cut).alias("_a")).select(*KEY, "_a.item", "_a.shift", "_a.along")
    rows = rows.join(items.select("item", "item_id", "item_words", "width"), "item")
    # Item place j meets word j + min(shift, 0) of `along`.
    starts = F.filter(
        F.sequence(F.lit(0), last),
        lambda s: (s + F.least("shift", F.lit(0)) >= 0)
        & (
            F.slice("along", F.greatest(s + F.least("shift", F.lit(0)), F.lit(0)) + 1, F.col("width"))
            == F.slice("item_words", s + 1, F.col("width"))
        ),
    )
    rows = rows.withColumn("_s", starts).where(F.size("_s") > 0)
    return rows.select(*KEY, "item_id", "width", F.transform("_s", lambda s: s + F.col("shift")).alias("starts"))


def proximity_matches(docs: DataFrame, benchmark: DataFrame, reach: int = 20, window: int = WINDOW, anchors: int = ANCHORS) -> DataFrame:
    """(document key, item_id, start, pos): windows whose anchors all occur within
    `reach` words of an occurrence of the rarest one (at pos), in any order.

    Positions are bucketed by `reach`, so that the join is on equality.
    """
    items = stage(_items(benchmark, window), "bench_items")
    chosen = _anchors(items, docs, anchors)
    order = Window.partitionBy("item", "start").orderBy("place")
    chosen = chosen.withColumn("_first", F.row_number().over(order) == 1)
    chosen = chosen.withColumn("_needs", F.count("*").over(Window.partitionBy("item", "start")))
    index = stage(postings(docs, chosen), "bench_postings")
    near = index.select(
        *KEY, F.col("term").alias("_t"), F.col("pos").alias("_p"), F.explode(F.array(*[F.floor(F.col("pos") / reach) + i for i in (-1, 0, 1)])).alias("_cell")
    )
    lead = index.join(chosen.where("_first").select("item", "start", "term", "_needs"), "term").withColumn("_cell", F.floor(F.col("pos") / reach))
    met = lead.select(*KEY, "_cell", "item", "start", "_needs", "pos").join(near, [*KEY, "_cell"])
    met = met.where(F.abs(F.col("pos") - F.col("_p")) <= reach)
    met = met.join(chosen.select("item", "start", F.col("term").alias("_t")), ["item", "start", "_t"])
    full = met.groupBy(*KEY, "item", "start", "_needs", "pos").agg(F.collect_set("_t").alias("_terms"))
    full = full.where(F.size("_terms") == F.col("_needs"))
    return full.join(items.select("item", "item_id"), "item").select(*KEY, "item_id", "start", "pos")


def _covered(spans: Column) -> Column:
    """Words in the union of sorted (start, width) spans."""
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(s["start"] + s["width"] - F.greatest(acc["end"], s["start"]), F.lit(0))).alias("n"),
        F.greatest(acc["end"], s["start"] + s["width"]).alias("end"),
    )
    return F.aggregate(spans, none, step, lambda acc: acc["n"])


@shielded("doc_id", "text", made=("n_words", "n_hit", "n_items", "item_ids", "contaminated"))
def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, anchors: int = ANCHORS) -> DataFrame:
    """`docs` with n_words, n_hit, n_items, item_ids and contaminated.

    n_hit counts words inside any occurrence of a window; item_ids are those of
    items with occurring windows, sorted as strings. Null and empty texts have no
    words; items without words are ignored; repeated rows get equal results. Rows
    are keyed by id and text, so ids may be null or repeat. Other columns pass
    through; columns named like an output are replaced.
    """
    made = ["n_words", "n_hit", "n_items", "item_ids", "contaminated"]
    kept = [c for c in docs.columns if c not in (*made, *KEY)]
    keyed = docs.select(*kept, *row_key("doc_id", "text"))
    found = phrase_matches(keyed.select(*KEY, "text").where("text is not null"), benchmark, window, anchors)
    spans = F.transform("starts", lambda s: F.struct(s.cast("int").alias("start"), F.col("width").cast("int").alias("width")))
    # One row per document with hits; distinct spans are bounded by its words.
    hits = found.select(*KEY, "item_id", F.explode(spans).alias("span")).groupBy(*KEY).agg(
        F.array_sort(F.collect_set("span")).alias("_spans"), F.array_sort(F.collect_set("item_id")).alias("_items")
    )
    hits = stage(hits.select(*KEY, _covered(F.col("_spans")).alias("_hit"), "_items"), "bench_hits")
    return (
        keyed.withColumn("n_words", word_count(F.col("text")).cast("long"))
        .join(hits, KEY, "left")
        .select(
            *kept,
            "n_words",
            F.coalesce("_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("_items"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("_items", F.array().cast("array<string>")).alias("item_ids"),
            F.col("_hit").isNotNull().alias("contaminated"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without those that hold a window of the benchmark."""
    return decontaminate(docs, benchmark).where(~F.col("contaminated")).select(*docs.columns)
