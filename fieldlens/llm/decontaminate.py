"""Benchmark decontamination by a distributed positional inverted index.

1. Windows of the test items, and how long the posting list of each of their terms is in the documents. A window with a term
   that no document has is gone.
2. Each window is probed by its two rarest positions. Postings (term, document, position) of those terms are stored,
   dealt by term and document, so that a frequent term has no task of its own.
3. Phrases: lists are moved by the term's place in the item and intersected from the rarest on. What is left says in which
   document an item may stand, and where; each such alignment is a row that is compared word by word.
4. Proximity: of the distinct pairs of rarest terms, the documents that hold both are intersected first, then the places where
   they stand within the span; each such place is a row whose neighbourhood is searched for all words of the pair's windows.

Words are the runs of characters other than ASCII non-alphanumerics, with A-Z lower-cased. All steps are DataFrame
functions.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldlens.llm.common import BROADCAST_ROWS, keep, materialize, small
from fieldlens.llm.quality import ASCII_LOWER, ASCII_UPPER

BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WINDOW = 10
# A proximity match: all words of a window, as often as it has them, in any order within so many times its length.
SPAN = 2


def words_of(text):
    """Array of the words of a text; null has none."""
    return F.coalesce(F.array_remove(F.split(F.translate(text, ASCII_UPPER, ASCII_LOWER), BREAK), ""), F.array().cast("array<string>"))


def item_words(items, text="text", item_id="item_id", window=WINDOW):
    """A row per item with words: item (a number), item_id, item_words, length (of its windows)."""
    found = keep(items, item_id, text).select(F.col(item_id).alias("item_id"), words_of(F.col(text)).alias("item_words"))
    found = found.filter(F.size("item_words") > 0).withColumn("length", F.least(F.size("item_words"), F.lit(window)))
    return found.distinct().withColumn("item", F.xxhash64("item_id", "item_words"))


def document_terms(docs, text="text", doc_id="doc_id"):
    """A row per word: id, key (hash of the text), pos, term."""
    return docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("key"), F.posexplode(words_of(F.col(text))).alias("pos", "term"))


def list_lengths(docs, terms, text="text", doc_id="doc_id"):
    """(term, n): postings of each of ``terms`` that the documents have; counts are combined before the shuffle."""
    words = docs.select(F.explode(words_of(F.col(text))).alias("term"))
    return words.join(small(terms), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def live_windows(items, lengths):
    """A row per window that can occur: item, start, length and its two rarest positions term1, at1, term2, at2 (the same one twice
    for windows of one word)."""
    places = items.select("item", "length", F.size("item_words").alias("size"), F.posexplode("item_words").alias("at", "term"))
    starts = F.explode(F.sequence(F.greatest(F.lit(0), F.col("at") - F.col("length") + 1),
                                  F.least(F.col("at"), F.col("size") - F.col("length"))))
    in_window = places.select("item", "length", "at", "term", starts.alias("start")).join(lengths, "term")
    order = Window.partitionBy("item", "start").orderBy("n", "term", "at")
    ranked = in_window.withColumn("rank", F.row_number().over(order)).withColumn(
        "present", F.count(F.lit(1)).over(Window.partitionBy("item", "start")))
    live = ranked.filter("present = length AND rank <= 2").groupBy("item", "start", "length").agg(
        F.min(F.when(F.col("rank") == 1, F.struct("term", "at"))).alias("one"),
        F.min(F.when((F.col("rank") == 2) | (F.col("length") == 1), F.struct("term", "at"))).alias("two"))
    return live.select("item", "start", "length", F.col("one.term").alias("term1"), F.col("one.at").alias("at1"),
                       F.col("two.term").alias("term2"), F.col("two.at").alias("at2"))


def probes(windows):
    """The rarest positions of all windows, once per item."""
    return windows.select("item", "term1", "at1", "term2", "at2").distinct()


def postings(docs, terms, text="text", doc_id="doc_id"):
    """The stored index: (term, id, key, pos) of the given terms."""
    found = document_terms(docs, text, doc_id).join(small(terms), "term").select("term", "id", "key", "pos")
    return materialize(found.repartition("term", "key").sortWithinPartitions("term", "id", "key", "pos"), "postings")


def alignments(index, pairs):
    """(id, key, item, shift): where the offset-adjusted lists of a probe's two terms meet; word j of the item would stand
    at position shift + j of the document."""
    first = index.join(small(pairs), index["term"] == pairs["term1"]).select(
        "id", "key", "item", "term1", "at1", "term2", "at2", (F.col("pos") - F.col("at1")).alias("shift"))
    alone = first.filter("at1 = at2").select("id", "key", "item", "shift")
    second = index.select(F.col("term").alias("term2"), F.col("id").alias("id2"), F.col("key").alias("key2"), F.col("pos").alias("pos2"))
    at_second = first.filter("at1 <> at2").withColumnRenamed("term2", "term").withColumn("pos", F.col("shift") + F.col("at2"))
    meet = at_second.join(second, (F.col("term") == F.col("term2")) & (F.col("key") == F.col("key2"))
                          & F.col("id").eqNullSafe(F.col("id2")) & (F.col("pos") == F.col("pos2")), "left_semi")
    return alone.union(meet.select("id", "key", "item", "shift")).distinct()


def pair_id():
    """Number of a window's two rarest terms and its span."""
    return F.xxhash64("term1", "term2", "span")


def near_places(index, pairs):
    """(id, key, pair, span, at): places of a pair's first term that have its second one fewer than ``span`` words away.
    ``pairs``: term1, term2, span, once each. Documents that hold both terms are found before any places are compared."""
    lists = index.groupBy("term", "id", "key").agg(F.array_sort(F.collect_list("pos")).alias("places"))
    first = lists.join(small(pairs), lists["term"] == pairs["term1"]).drop("term")
    second = lists.select(F.col("term").alias("other"), F.col("id").alias("id2"), F.col("key").alias("key2"), F.col("places").alias("places2"))
    met = first.join(second, (F.col("term2") == F.col("other")) & (F.col("key") == F.col("key2")) & F.col("id").eqNullSafe(F.col("id2")))
    near = F.expr("filter(places, p -> exists(places2, q -> q <> p AND abs(q - p) < span))")
    return met.select("id", "key", pair_id().alias("pair"), "span", F.explode(near).alias("at"))


def phrase_index(docs, items, text="text", doc_id="doc_id"):
    """(index, live windows) of the items over the documents; both are written to the shared folder."""
    terms = materialize(items.select(F.explode("item_words").alias("term")).distinct(), "test-terms")
    lengths = materialize(list_lengths(docs, terms, text, doc_id), "list-lengths")
    windows = materialize(live_windows(items, lengths), "live-windows")
    wanted = materialize(windows.select(F.explode(F.array("term1", "term2")).alias("term")).distinct(), "probe-terms")
    return postings(docs, wanted, text, doc_id), windows


def neighbourhoods(docs, found, text="text", doc_id="doc_id"):
    """The rows of ``found`` (id, key, kind, ref, at, lo, size; written) with ``words``: ``size`` words of the document from word ``lo`` on.

    Only documents that are asked for are split, where they are read: what is sent to them is their list of places, a few numbers
    each, as long as there are few enough places in all.
    """
    places = found.groupBy("id", "key").agg(F.collect_list(F.struct("kind", "ref", "at", "lo", "size")).alias("places"))
    fits = found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    both = docs.withColumn("__key", F.xxhash64(text)).join(
        F.broadcast(places) if fits else places, F.col(doc_id).eqNullSafe(F.col("id")) & (F.col("__key") == F.col("key")))
    rows = both.select("id", "key", words_of(F.col(text)).alias("__words"), F.explode("places").alias("p"))
    return rows.select("id", "key", "p.*", F.slice("__words", F.col("p.lo") + 1, F.col("p.size")).alias("words"))


def phrase_hits(beside, tests):
    """(id, key, item, item_id, positions): occurrences of windows at each alignment, by comparing the item with the document's words
    beside it. ``positions`` are the document's words that are hit."""
    rows = beside.filter("kind = 0").withColumnRenamed("ref", "item").join(small(tests), "item")
    starts = F.expr(
        "filter(sequence(0, size(item_words) - length), s -> at + s >= lo AND at + s + length - lo <= size(words) "
        "AND slice(words, at + s - lo + 1, length) = slice(item_words, s + 1, length))")
    hits = rows.withColumn("starts", starts).filter(F.size("starts") > 0)
    return hits.select("id", "key", "item", "item_id", F.expr(
        "array_distinct(flatten(transform(starts, s -> sequence(at + s, at + s + length - 1))))").alias("positions"))


def near_hits(around, windows, tests):
    """(id, key, item, item_id): items of which a window's words all stand within the span around a place of ``near_places``."""
    slices = windows.join(tests.select("item", "item_id", "item_words"), "item").withColumn("span", F.col("length") * SPAN).select(
        pair_id().alias("ref"), "span", "item", "item_id", F.expr("array_sort(slice(item_words, start + 1, length))").alias("sorted")).distinct()
    counted = slices.withColumn("needed", F.expr(
        "transform(array_distinct(sorted), w -> struct(w AS word, size(filter(sorted, x -> x = w)) AS n))")).drop("sorted")
    holds = "forall(needed, c -> size(filter({0}, x -> x = c.word)) >= c.n)"
    met = around.filter("kind = 1").join(small(materialize(counted, "near-windows")), "ref").filter(holds.format("words"))
    met = met.filter(F.expr("exists(sequence(0, greatest(0, size(words) - span)), s -> " + holds.format("slice(words, s + 1, span)") + ")"))
    return met.select("id", "key", "item", "item_id")


def _named(items):
    """(number of items, their sorted ids as strings) of the rows (item, item_id); an item without an id counts but isn't named."""
    name = F.col("item_id").cast("string")
    return (F.size(F.collect_set(F.coalesce(name, F.concat(F.lit("#"), "item")))).cast("long").alias(f"n_{items}"),
            F.array_sort(F.collect_set(name)).alias(items))


def contamination(docs, items, text="text", doc_id="doc_id", item_text="text", item_id="item_id", window=WINDOW):
    """One row per row of ``docs``: the id, text_key (hash of the text), n_words, n_hit, n_items, items (sorted item ids as
    strings), n_near, near (likewise, of proximity matches), contaminated (some word is hit).

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window. A word of a
    document inside any occurrence of a window is hit. A proximity match has all words of a window within ``SPAN`` times its
    length, in any order, so every occurrence is one too; an item of fewer words has only these, as a few words that stand close say
    nothing. Null texts and texts without words have no words and no windows;
    an item with a null id counts as an item but is not named. Rows with a null id and repeated rows are judged each. Other columns
    aren't read. Empty documents give an empty result, empty items no hits. The result is written before it is returned, so a
    filter on it never runs the search twice.
    """
    bare = keep(docs, doc_id, text)
    tests = materialize(item_words(items, item_text, item_id, window), "test-items")
    index, windows = phrase_index(bare, tests, text, doc_id)
    pairs = materialize(probes(windows), "probes")
    aligned = alignments(index, pairs).join(small(tests.select("item", F.size("item_words").alias("n"))), "item")
    spans = materialize(windows.filter((F.col("length") == window) & (F.col("length") > 1)).select(
        "term1", "term2", (F.col("length") * SPAN).alias("span")).distinct(), "near-pairs")
    near = near_places(index, spans)
    from_, start = F.greatest(F.lit(0), F.col("shift")), F.greatest(F.lit(0), F.col("at") - F.col("span") + 1)
    found = materialize(aligned.select(
        "id", "key", F.lit(0).alias("kind"), F.col("item").alias("ref"), F.col("shift").alias("at"), from_.alias("lo"),
        F.greatest(F.lit(0), F.col("shift") + F.col("n") - from_).alias("size")).unionByName(near.select(
            "id", "key", F.lit(1).alias("kind"), F.col("pair").alias("ref"), "at", start.alias("lo"), (F.col("at") + F.col("span") - start).alias("size"))),
        "places")
    beside = materialize(neighbourhoods(bare, found, text, doc_id), "neighbourhoods")
    hits = materialize(phrase_hits(beside, tests), "phrase-hits")
    met = near_hits(beside, windows, tests).union(hits.select("id", "key", "item", "item_id"))

    # words that are hit are counted by document and position, so a document full of them is no single list
    n_hit = hits.select("id", "key", F.explode("positions").alias("pos")).distinct().groupBy("id", "key").agg(F.count(F.lit(1)).alias("n_hit"))
    parts = [n_hit, hits.groupBy("id", "key").agg(*_named("items")), met.groupBy("id", "key").agg(*_named("near"))]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = ("n_hit", "n_items", "items", "n_near", "near")
    each = materialize(every.groupBy("id", "key").agg(*[F.max(c).alias(c) for c in names]), "contaminated")
    read = bare.select(doc_id, F.xxhash64(text).alias("text_key"), F.size(words_of(F.col(text))).cast("long").alias("n_words"))
    out = read.join(small(each), F.col(doc_id).eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")), "left")
    none, nothing = F.lit(0).cast("long"), F.array().cast("array<string>")
    out = out.select(doc_id, "text_key", "n_words", *[F.coalesce(c, nothing if c in ("items", "near") else none).alias(c) for c in names])
    return materialize(out, "contamination").withColumn("contaminated", F.col("n_hit") > 0)
