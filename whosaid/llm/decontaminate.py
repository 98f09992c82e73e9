"""Operator 9: benchmark decontamination by a positional inverted index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from whosaid.llm.tables import stored

# What a word is, and the letters that are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words of a window.
WINDOW = 10
#: Words of a stretch that holds all words of a window in any order.
WITHIN = 12
#: The index's terms are broadcast up to this many; more of them are joined by
#: a shuffle.
BROADCAST_TERMS = 200_000

#: What follows a document's last word: the term of it, at the position that is
#: the number of words. No word has these characters.
END = ("\x00end", "\x00")


def words_of(text: Column) -> Column:
    lowered = F.translate(text, UPPER, LOWER)
    found = F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def test_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (item_id, words): every window of every item.

    An item with fewer words is one window. Items without an id, text or word
    have none.
    """
    items = benchmark.where("item_id is not null").select(
        F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("w")
    )
    last = F.greatest(F.size("w") - window, F.lit(0))
    starts = F.explode(F.sequence(F.lit(0), last)).alias("s")
    return (
        items.where(F.size("w") > 0)
        .select("item_id", "w", starts)
        .select("item_id", F.slice("w", F.col("s") + 1, window).alias("words"))
        .distinct()
    )


def terms_of(windows: DataFrame) -> DataFrame:
    """Rows (window, length, offset, first, second) for each window's terms.

    A term is a word with its successor, so that a frequent word costs no
    posting unless the word after it fits too; a window of one word has that
    word and any successor as its only term.
    """
    pairs = F.posexplode(
        F.transform(
            F.sequence(F.lit(0), F.greatest(F.size("words") - 2, F.lit(0))),
            lambda i: F.struct(
                F.get("words", i).alias("first"), F.get("words", i + 1).alias("second")
            ),
        )
    ).alias("offset", "t")
    return windows.select("window", F.size("words").alias("length"), pairs).select(
        "window", "length", "offset", "t.first", "t.second"
    )


def words_as_terms(windows: DataFrame) -> DataFrame:
    """Rows as of terms_of, with each single word as a term, whatever follows it."""
    return windows.select(
        "window", F.size("words").alias("length"), F.posexplode("words").alias("offset", "first")
    ).withColumn("second", F.lit(None).cast("string"))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored index: rows (row, doc_id, pos, term) for the given terms.

    One pass over the whole texts, no shuffle of them. ``row`` stands for a row
    of the input, whatever its doc_id. Each row has a posting of term -1 at the
    position after its last word. A null text has no words.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.concat(words_of(F.col("text")), F.array(*map(F.lit, END))).alias("words"),
    )
    tokens = rows.select("row", "doc_id", "words", F.posexplode("words").alias("pos", "w"))
    few = terms.count() <= BROADCAST_TERMS
    hinted = F.broadcast if few else (lambda df: df)
    end = terms.sparkSession.createDataFrame([(-1, *END)], terms.schema)
    pairs = terms.where("second is not null").union(end)
    after = F.get("words", F.col("pos") + 1)
    postings = (
        tokens.select(
            "row", "doc_id", "pos", "w", after.alias("after"), F.xxhash64("w", after).alias("key")
        )
        .join(hinted(pairs.withColumn("key", F.xxhash64("first", "second"))), "key")
        .where((F.col("w") == F.col("first")) & (F.col("after") == F.col("second")))
        .select("row", "doc_id", "pos", "term")
    )
    alone = terms.where("second is null")
    if not alone.isEmpty():
        # Windows of one word, whatever follows it, are looked up in their own pass.
        single = tokens.join(hinted(alone), F.col("w") == F.col("first"))
        postings = postings.union(single.select("row", "doc_id", "pos", "term"))
    return stored(postings)


def phrase_matches(index: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows (row, window, start, length): where whole windows occur.

    A window's terms are ranked by their postings. The lists of the two rarest
    are intersected after taking off their offsets; for what is left, the
    places of all other terms are looked up in the index.
    """
    counts = index.groupBy("term").agg(F.count("*").alias("n"))
    ranked = (
        windows.join(counts, "term")
        .withColumn("seen", F.count("*").over(Window.partitionBy("window")))
        .withColumn(
            "rank", F.row_number().over(Window.partitionBy("window").orderBy("n", "offset"))
        )
        .where("seen = terms")
        .drop("n", "seen")
    )

    def starts(rank: int) -> DataFrame:
        terms = ranked.where(F.col("rank") == rank).select(
            "term", "window", "offset", "length", "terms"
        )
        return index.join(terms, "term").select(
            "row", "window", (F.col("pos") - F.col("offset")).alias("start"), "length", "terms"
        )

    place = ["row", "window", "start"]
    rarest = starts(1)
    both = rarest.where("terms > 1").join(starts(2).select(place), place, "left_semi")
    rest = ranked.where("rank > 2").select("window", "offset", "term")
    wanted = both.where("terms > 2").join(rest, "window").select(
        *place, "length", "terms", (F.col("start") + F.col("offset")).alias("pos"), "term"
    )
    whole = (
        wanted.join(index.select("row", "pos", "term"), ["row", "pos", "term"])
        .groupBy(*place, "length", "terms")
        .agg(F.count("*").alias("n"))
        .where("n = terms - 2")
    )
    out = [*place, "length"]
    return (
        rarest.where("terms = 1").select(out)
        .union(both.where("terms = 2").select(out))
        .union(whole.select(out))
    )


def proximity_matches(index: DataFrame, windows: DataFrame, within: int) -> DataFrame:
    """Rows (row, window, start, end): all of a window's terms in any order
    within a stretch of ``within`` words, one row per smallest such stretch of
    each end. ``windows`` as for phrase_matches; equal terms count once. For
    windows of several words the terms have to be single words (``indexed`` with
    ``near``): a pair is gone where a word is inserted or exchanged.

    A window's terms are ranked by their postings. Only places of the rarest with
    the second within the stretch are looked at; the postings of all terms are
    joined to the blocks of ``within`` words around them.
    """
    counts = index.groupBy("term").agg(F.count("*").alias("n"))
    listed = windows.select("window", "term").distinct()
    listed = listed.withColumn("terms", F.count("*").over(Window.partitionBy("window")))
    ranked = (
        listed.join(counts, "term")
        .withColumn("seen", F.count("*").over(Window.partitionBy("window")))
        .withColumn("rank", F.row_number().over(Window.partitionBy("window").orderBy("n", "term")))
        .where("seen = terms")
        .select("window", "term", "terms", "rank")
    )

    def block(pos: str | Column) -> Column:
        return F.floor(F.col(pos) / within)

    blocks = F.explode(F.sequence(block("at") - 1, block("at") + 1)).alias("block")
    rarest = (
        index.join(ranked.where("rank = 1"), "term")
        .select("row", "window", "terms", F.col("pos").alias("at"))
        .select("row", "window", "terms", "at", blocks)
    )
    second = index.join(ranked.where("rank = 2").select("term", "window"), "term").select(
        "row", "window", block("pos").alias("block"), "pos"
    )
    places = ["row", "window", "block"]
    both = (
        rarest.where("terms > 1")
        .join(second, places)
        .where(F.abs(F.col("pos") - F.col("at")) < within)
        .select("row", "window", "terms", "at")
        .distinct()
        .select("row", "window", "terms", "at", blocks)
    )
    wanted = rarest.where("terms = 1").union(both).select(*places, "terms").distinct()
    hits = (
        wanted.join(ranked.select("window", "term"), "window")
        .join(index.withColumn("block", block("pos")), ["row", "block", "term"])
        .select("row", "window", "term", "terms", "pos")
    )
    near = (
        Window.partitionBy("row", "window").orderBy("pos").rangeBetween(-(within - 1), 0)
    )
    latest = F.collect_list(F.struct("pos", "term")).over(near)

    def newest(seen: Column) -> Column:
        """Each term's last position in the stretch."""
        return F.transform(
            F.array_distinct(F.transform(seen, lambda s: s["term"])),
            lambda t: F.array_max(
                F.transform(F.filter(seen, lambda s: s["term"] == t), lambda s: s["pos"])
            ),
        )

    return (
        hits.withColumn("places", newest(latest))
        .where(F.size("places") == F.col("terms"))
        .select(
            "row", "window", F.array_min("places").alias("start"), (F.col("pos") + 1).alias("end")
        )
        .distinct()
    )


def indexed(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, near: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The index, the windows' terms as rows (window, length, offset, term,
    terms), and the items of each window as rows (window, item_id).

    With ``near`` the terms are single words, for proximity_matches; without, a
    word with its successor, which exact phrases need fewer postings of.
    """
    listed = test_windows(benchmark, window)
    numbered = stored(
        listed.select("words").distinct().withColumn("window", F.monotonically_increasing_id())
    )
    pairs = words_as_terms(numbered) if near else terms_of(numbered)
    terms = stored(
        pairs.select("first", "second")
        .distinct()
        .select(F.monotonically_increasing_id().alias("term"), "first", "second")
    )
    windows = stored(
        pairs.join(
            terms,
            (pairs["first"] == terms["first"]) & pairs["second"].eqNullSafe(terms["second"]),
        ).select(
            "window",
            "length",
            "offset",
            "term",
            F.count("*").over(Window.partitionBy("window")).alias("terms"),
        )
    )
    items = listed.join(numbered, "words").select("window", "item_id")
    return build_index(docs, terms), windows, items


def near_passages(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, within: int = WITHIN
) -> DataFrame:
    """Rows (row, doc_id, n_near, items) for each row of (doc_id, text).

    n_near counts the stretches of at most ``within`` words that hold all
    distinct words of a window of a benchmark item in any order, the smallest of
    each end and window; items are the sorted ids of the items with such a
    window. Words may be inserted or exchanged.
    """
    index, windows, items = indexed(docs, benchmark, window, near=True)
    matches = stored(proximity_matches(index, windows, within))
    n_near = matches.groupBy("row").agg(F.count("*").alias("n_near"))
    seen = (
        matches.select("row", "window")
        .distinct()
        .join(items, "window")
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    return (
        index.where("term = -1")
        .select("row", "doc_id")
        .join(n_near, "row", "left")
        .join(seen, "row", "left")
        .select(
            "row",
            "doc_id",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (row, doc_id, n_words, n_hit, items) for each row of (doc_id, text).

    n_hit counts the words inside any occurrence of a window of a benchmark
    item, items are the sorted ids, as text, of the items with an occurring
    window. Rows without words, and all rows if the benchmark is empty, have
    none. Repeated rows each have their own result.
    """
    index, windows, items = indexed(docs, benchmark, window)
    matches = stored(phrase_matches(index, windows))
    end = F.col("start") + F.col("length")
    before = F.max(end).over(
        Window.partitionBy("row").orderBy("start", "length").rowsBetween(
            Window.unboundedPreceding, -1
        )
    )
    new = F.greatest(
        end - F.greatest(F.col("start"), F.coalesce(before, F.lit(0))), F.lit(0)
    )
    hit = (
        matches.select("row", "start", "length")
        .distinct()
        .select("row", new.alias("new"))
        .groupBy("row")
        .agg(F.sum("new").alias("n_hit"))
    )
    seen = (
        matches.select("row", "window")
        .distinct()
        .join(items, "window")
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    return (
        index.where("term = -1")
        .select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))
        .join(hit, "row", "left")
        .join(seen, "row", "left")
        .select(
            "row",
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )
