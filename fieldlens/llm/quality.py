"""Quality rules: text statistics of each document and the frequency of its lines across the documents of a host.

Lines are normalised and hashed, distinct documents are counted per host and line, lines above the limit go, and a
document that loses too many of its words is rejected. Copies of one document count once: documents whose whole text agrees
are one document in these counts (a family of copies is the work of deduplication, not of this rule).

Everything is DataFrame functions. Statistics come from arrays within the row, so a text is never shuffled for them; only
line hashes are, and their hot groups combine on the map side or are dealt by (host, line, document).
"""

from pyspark.sql import functions as F

from fieldlens.llm.common import SPACE, WORD, keep, materialize, need

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LINE_DOCS = 20
MIN_LEFT_PERCENT = 30


def words_of(text):
    """Array of words; null text has none."""
    return F.coalesce(F.array_remove(F.split(text, SPACE), ""), F.array().cast("array<string>"))


def text_statistics(docs, text="text"):
    """The columns of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (all long).

    Three-word windows are compared by a 64-bit hash of which, in a text of n words, 64 - log2(n) bits are used: sorted
    beside their position in one long, equal windows are neighbours.
    """
    filled = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("__w", words_of(F.col(text))).withColumn("n_words", F.size("__w").cast("long"))
    out = out.withColumn("__l", F.expr(f"filter(split({_name(text)}, '\\n'), l -> l rlike r'{WORD}')"))
    out = out.withColumns({
        "word_chars": F.length(F.array_join("__w", "")).cast("long"),
        "n_symbols": (F.length(filled) - F.length(F.translate(filled, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": F.coalesce(F.size("__l") - F.size(F.array_distinct("__l")), F.lit(0)).cast("long"),
        "__bits": F.ceil(F.log2(F.col("n_words") + 2)).cast("int"),
        "__g": F.expr("CASE WHEN n_words >= 3 THEN transform(sequence(0, cast(n_words AS int) - 3), "
                      "i -> xxhash64(__w[i], __w[i + 1], __w[i + 2])) END"),
    }).drop("__w", "__l")
    out = out.withColumn("__s", F.expr(
        "CASE WHEN size(array_distinct(__g)) < size(__g) THEN "
        "sort_array(transform(__g, (h, i) -> shiftleft(shiftright(h, __bits), __bits) | cast(i AS bigint))) END")).drop("__g")
    out = out.withColumn("__p", F.expr(
        "sort_array(array_distinct(flatten(array_compact(zip_with(__s, slice(__s, 2, size(__s)), (a, b) -> "
        "CASE WHEN shiftright(a, __bits) = shiftright(b, __bits) THEN "
        "array(a & (shiftleft(1L, __bits) - 1), b & (shiftleft(1L, __bits) - 1)) END)))))")).drop("__s", "__bits")
    covered = F.expr("aggregate(zip_with(__p, slice(__p, 2, size(__p)), (a, b) -> coalesce(least(b - a, 3L), 3L)), 0L, (s, x) -> s + x)")
    return out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("__p")


def _name(column):
    return f"`{column}`"



def document_lines(docs, text="text", host="source", doc_id="doc_id"):
    """A row per line that has a word: __id and __key (of the document), __host, pos, line, n_words.

    ``__key``, the hash of the whole text, stands for the document in counts.
    """
    lines = F.expr(f"filter(transform(split({_name(text)}, '\\n'), l -> translate(array_join(array_remove(split(l, r'{SPACE}'), ''), ' '), "
                   f"'{ASCII_UPPER}', '{ASCII_LOWER}')), l -> l <> '')")
    base = docs.select(F.col(doc_id).alias("__id"), F.xxhash64(text).alias("__key"), F.col(host).alias("__host"), lines.alias("__lines"))
    found = base.select("__id", "__key", "__host", F.posexplode("__lines").alias("pos", "l"))
    return found.select("__id", "__key", "__host", "pos", F.xxhash64("l").alias("line"),
                        (F.length("l") - F.length(F.translate("l", " ", "")) + 1).cast("long").alias("n_words"))


def frequent_lines(lines, max_docs=MAX_LINE_DOCS):
    """(__host, line) of the lines found in more than ``max_docs`` distinct documents of a host, whatever its size."""
    counts = lines.groupBy("__host", "line").agg(F.countDistinct("__key").alias("n_docs"))
    return counts.filter(F.col("n_docs") > max_docs).select("__host", "line")


def removed_lines(docs, text="text", host="source", doc_id="doc_id", max_docs=MAX_LINE_DOCS):
    """A row per document that loses lines: __id, __key, __host, removed_words, removed (hashes of its removed lines). One id and
    text under two hosts are two documents."""
    lines = materialize(document_lines(keep(docs, doc_id, text, host), text, host, doc_id), "quality-lines")
    frequent = materialize(frequent_lines(lines, max_docs), "quality-frequent").select(
        F.col("__host").alias("__frequent_host"), F.col("line").alias("__line"))
    hits = lines.join(frequent, F.col("__host").eqNullSafe(F.col("__frequent_host")) & (F.col("line") == F.col("__line")))
    # a row of the table that occurs twice has its lines once
    once = hits.groupBy("__id", "__key", "__host", "pos").agg(F.first("line").alias("line"), F.first("n_words").alias("n_words"))
    return once.groupBy("__id", "__key", "__host").agg(F.sum("n_words").alias("removed_words"), F.collect_set("line").alias("removed"))


def quality_rules(docs, text="text", host="source", doc_id="doc_id", with_lines=False, min_words=MIN_WORDS,
                  max_repeat_percent=MAX_REPEAT_PERCENT, max_docs=MAX_LINE_DOCS,
                  min_left_percent=MIN_LEFT_PERCENT):
    """One row per row of ``docs``: the id, text_key (hash of the text), host, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, removed_words, base_failed, kept; with ``with_lines`` also removed, the hashes of the removed lines
    (null if there are none), for ``without_lines``.

    base_failed: fewer than ``min_words`` words, or more than ``max_repeat_percent`` % of them in repeated three-word
    windows. kept: not base_failed and at least ``min_left_percent`` % of the words left after the removal of lines.
    Null and empty texts have no words and fail. A null host is a host of its own; null ids and repeated rows are judged
    like others, a repeated row counts once. Other columns aren't read. An empty table gives an empty result.

    Statistics are written before anything is asked of them, so a filter on them never runs them twice.
    """
    need(docs, doc_id, text, host)
    removed = removed_lines(docs, text, host, doc_id, max_docs).withColumnsRenamed(
        {"__id": "__rid", "__key": "__rkey", "__host": "__rhost"})
    read = keep(docs, doc_id, text, host).select(F.col(doc_id), F.col(text), F.xxhash64(text).alias("text_key"), F.col(host).alias("__host"))
    stats = materialize(text_statistics(read, text).select(
        doc_id, "text_key", F.col("__host").alias("host"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), "quality-statistics")
    found = stats.join(removed if with_lines else removed.drop("removed"),
                       F.col(doc_id).eqNullSafe(F.col("__rid")) & (F.col("text_key") == F.col("__rkey"))
                       & F.col("host").eqNullSafe(F.col("__rhost")), "left")
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    lost = F.coalesce(F.col("removed_words"), F.lit(0).cast("long"))
    left = (F.col("n_words") - lost) * 100 >= F.col("n_words") * min_left_percent
    return found.select(
        doc_id, "text_key", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", lost.alias("removed_words"),
        failed.alias("base_failed"), (~failed & left).alias("kept"), *(["removed"] if with_lines else []))


def without_lines(text, removed):
    """SQL of the text column without the lines whose hashes are in the array column ``removed``; null removes nothing."""
    hashed = f"xxhash64(translate(array_join(array_remove(split(l, r'{SPACE}'), ''), ' '), '{ASCII_UPPER}', '{ASCII_LOWER}'))"
    return (f"CASE WHEN {_name(removed)} IS NULL THEN {_name(text)} ELSE array_join(filter(split({_name(text)}, '\\n'), "
            f"l -> NOT array_contains({_name(removed)}, {hashed})), '\\n') END")
