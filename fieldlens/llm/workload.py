"""Registered queries of the text operators, with their SQL where SQL can say it."""

from pyspark.sql import functions as F

from fieldlens.llm import (
    conversations, credentials, decontaminate, langid, lexical, mixing, quality, simhash, tokens, topk, toxicity, urls, weaklabels,
)

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def add(fn):
        def run(spark, sf_dir):
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_token_counts")
def op1(spark, table):
    """Tokens of every whole document by the byte-level vocabulary."""
    return tokens.token_counts(table("documents"), "byte_bpe_50k.json", limit=512)


@query("op4_mixing")
def op4(spark, table):
    """Words that the mix takes of every document."""
    return mixing.mix_sources(table("documents"))


WORDS_SQL = "list_filter(string_split_regex(coalesce({0}, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
OP9_SQL = f"""
    WITH docs AS (
        SELECT doc_id, source, text, {WORDS_SQL.format('text')} AS words, string_split(coalesce(text, ''), chr(10)) AS lines
        FROM documents),
    grams AS (
        SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM docs) t),
    repeated AS (
        SELECT doc_id, count(DISTINCT p) AS n
        FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
              FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) t WHERE n > 1) t
        GROUP BY doc_id),
    lines AS (
        SELECT doc_id, source, text, l AS raw, {WORDS_SQL.format('l')} AS w
        FROM (SELECT doc_id, source, text, unnest(lines) AS l FROM docs) t),
    named AS (
        SELECT doc_id, source, text, raw, len(w) AS n,
               translate(array_to_string(w, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line
        FROM lines WHERE len(w) > 0),
    frequent AS (SELECT source, line FROM named GROUP BY source, line HAVING count(DISTINCT text) > 20),
    removed AS (
        SELECT n.doc_id, sum(n.n) AS n FROM named n JOIN frequent f ON n.source IS NOT DISTINCT FROM f.source AND n.line = f.line
        GROUP BY n.doc_id),
    dups AS (SELECT doc_id, count(*) - count(DISTINCT raw) AS n FROM named GROUP BY doc_id),
    stats AS (
        SELECT d.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
               length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS n_symbols,
               coalesce(p.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(m.n, 0)::bigint AS removed_words
        FROM docs d LEFT JOIN repeated r USING (doc_id) LEFT JOIN dups p USING (doc_id) LEFT JOIN removed m USING (doc_id))
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * (n_words - removed_words) >= 30 * n_words AS kept
    FROM stats"""


@query("op9_quality_rules", OP9_SQL)
def op9(spark, table):
    """Statistics and verdict of every document."""
    return quality.quality_rules(table("documents")).drop("text_key", "host")


@query("op6_simhash")
def op6(spark, table):
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table("documents"), width=3, distance=2)


TERMS_SQL = ("list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')")
OP7_SQL = f"""
    WITH items AS (SELECT item_id, words, least(10, len(words)) AS l FROM (SELECT item_id, {TERMS_SQL} AS words FROM benchmark) t
                   WHERE len(words) > 0),
    windows AS (
        SELECT DISTINCT item_id, l, array_to_string(words[s:s + l - 1], ' ') AS w
        FROM (SELECT item_id, words, l, unnest(range(1, len(words) - l + 2)) AS s FROM items) t),
    docs AS (SELECT doc_id, {TERMS_SQL} AS words FROM documents),
    places AS (
        SELECT doc_id, l, s, array_to_string(words[s:s + l - 1], ' ') AS w
        FROM (SELECT doc_id, words, l, unnest(range(1, len(words) - l + 2)) AS s
              FROM docs, (SELECT DISTINCT l FROM windows) t WHERE len(words) >= l) t),
    hits AS (SELECT p.doc_id, p.s, p.l, w.item_id FROM places p JOIN windows w ON p.l = w.l AND p.w = w.w),
    hit_words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM hits) t GROUP BY doc_id),
    hit_items AS (
        SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::varchar, ',' ORDER BY item_id::varchar) AS ids
        FROM hits GROUP BY doc_id),
    all_windows AS (
        SELECT item_id, l, words[s:s + l - 1] AS w FROM (SELECT item_id, words, l, unnest(range(1, len(words) - l + 2)) AS s FROM items WHERE l = 10) t),
    occurrences AS (SELECT doc_id, words, unnest(words) AS term, unnest(range(1, len(words) + 1)) AS p FROM docs),
    counts AS (SELECT term, count(*) AS n FROM occurrences GROUP BY term),
    rarest AS (
        SELECT row_number() OVER () AS window_no, item_id, l, w, list_transform(list_distinct(w), lambda x: len(list_filter(w, lambda y: y = x))) AS ns,
               list_distinct(w) AS ws
        FROM all_windows),
    anchors AS (
        SELECT window_no, arg_min(term, n) AS term FROM (SELECT window_no, unnest(ws) AS term FROM rarest) t JOIN counts USING (term) GROUP BY window_no),
    around AS (
        SELECT r.item_id, r.l, r.ws, r.ns, o.doc_id, o.words[greatest(1, o.p - 2 * r.l + 1):o.p + 2 * r.l - 1] AS a
        FROM anchors JOIN rarest r USING (window_no) JOIN occurrences o USING (term)),
    close AS (
        SELECT *, unnest(range(1, greatest(1, len(a) - 2 * l + 1) + 1)) AS s FROM around
        WHERE len(list_filter(range(1, len(ws) + 1), lambda k: len(list_filter(a, lambda x: x = ws[k])) < ns[k])) = 0),
    near AS (
        SELECT DISTINCT doc_id, item_id FROM (SELECT doc_id, item_id, l, ws, ns, a[s:s + 2 * l - 1] AS a FROM close) t
        WHERE len(list_filter(range(1, len(ws) + 1), lambda k: len(list_filter(a, lambda x: x = ws[k])) < ns[k])) = 0
        UNION SELECT doc_id, item_id FROM hits),
    near_items AS (
        SELECT doc_id, count(*) AS n, string_agg(item_id::varchar, ',' ORDER BY item_id::varchar) AS ids FROM near GROUP BY doc_id)
    SELECT d.doc_id, len(d.words) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
           sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated, coalesce(m.n, 0) AS n_near,
           coalesce(m.ids, '') AS near_items
    FROM docs d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items i USING (doc_id) LEFT JOIN near_items m USING (doc_id)"""


@query("op7_decontamination", OP7_SQL)
def op7(spark, table):
    """Words of every document inside a window of a benchmark item, the items, and those whose words stand close together."""
    found = decontaminate.contamination(table("documents"), table("benchmark"), window=10)
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated", "n_near", F.array_join("near", ",").alias("near_items"))


@query("op7_proximity_matches", f"SELECT doc_id, n_near, near_items, contaminated FROM ({OP7_SQL}) t")
def op7_near(spark, table):
    """Benchmark items of which every document has all words of a window close together."""
    found = decontaminate.contamination(table("documents"), table("benchmark"), window=10)
    return found.select("doc_id", "n_near", F.array_join("near", ",").alias("near_items"), "contaminated")


@query("op8_secret_scans")
def op8(spark, table):
    """Counts and spans of the secrets of every document."""
    found = credentials.secret_spans(table("documents"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, credentials.KINDS), F.sha2(credentials.joined(F.col("base")), 256).alias("base_sha256"),
                        credentials.joined(F.col("spans")).alias("spans"))


URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


@query("op10_url_filters")
def op10(spark, table):
    """Verdict on the url of every page."""
    return urls.filter_urls(table("pages"), URL_RULES)


@query("op5_language_id")
def op5(spark, table):
    """Language of every document, learnt from the labelled documents that aren't held out."""
    return langid.language_id(table("documents"), folds=5)


@query("op2_toxicity")
def op2(spark, table):
    """Toxicity of every document, learnt from the labelled documents that aren't held out."""
    found = toxicity.toxicity(table("documents"), table("labels"), folds=3, held_out=1)
    joined = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return found.withColumn("n_spans", F.size("spans").cast("long")).withColumn("spans", joined)


@query("op3_quality_classifier")
def op3(spark, table):
    """Quality of every document, learnt from the votes of heuristic labellers."""
    return weaklabels.quality_classifier(table("documents"))


OP11_SQL = f"""
    WITH docs AS (SELECT doc_id, {TERMS_SQL} AS terms FROM documents),
    items AS (SELECT item_id, unnest({TERMS_SQL}) AS term FROM benchmark),
    asked AS (SELECT item_id, term, count(*) AS times FROM items GROUP BY ALL),
    sizes AS (SELECT count(*) AS n_docs, sum(len(terms))::bigint AS n_terms FROM docs WHERE len(terms) > 0),
    tf AS (SELECT doc_id, term, count(*) AS tf, any_value(n) AS n
           FROM (SELECT doc_id, len(terms)::bigint AS n, unnest(terms) AS term FROM docs) t
           WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
    weights AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)::double))::bigint AS w FROM tf, sizes GROUP BY term),
    parts AS (
        SELECT a.item_id, t.doc_id,
               a.times * w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (100 - 75 + (75 * t.n * s.n_docs) // s.n_terms))) AS part
        FROM asked a JOIN tf t USING (term) JOIN weights w USING (term), sizes s),
    scores AS (SELECT item_id, doc_id, sum(part)::bigint AS score FROM parts GROUP BY item_id, doc_id HAVING sum(part) > 0)
    SELECT item_id, rank::int AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores) t WHERE rank <= 10"""


@query("op11_lexical_search", OP11_SQL)
def op11(spark, table):
    """The ten documents that score highest for every benchmark item."""
    return lexical.ranked_search(table("documents"), table("benchmark"), k=10)


OP12_SQL = """
    WITH RECURSIVE crc AS (
        SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))
               AS t),
    marked AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               xor(list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''),
                                                                        lambda c: ascii(c)::bigint)),
                               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
        FROM conversations, crc),
    damaged AS (
        SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM marked WHERE kind <> 0),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
               right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS ending
        FROM damaged),
    judged AS (
        SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
               CASE WHEN ending = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                    WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault
        FROM placed),
    counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
               count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
        FROM judged GROUP BY conv_id),
    inserts(state, audit, lines, reached) AS (VALUES
        (0, '', []::varchar[], 0), (0, 'I', ['user:'], 2), (0, 'II', ['user:', 'assistant:'], 3),
        (1, '', []::varchar[], 1), (1, 'I', ['user:'], 2), (1, 'II', ['user:', 'assistant:'], 3),
        (2, '', []::varchar[], 2), (2, 'I', ['assistant:'], 3), (2, 'II', ['assistant:', 'user:'], 2),
        (3, '', []::varchar[], 3), (3, 'I', ['user:'], 2), (3, 'II', ['user:', 'assistant:'], 3)),
    edits(state, edit, initial, reached, role) AS (VALUES
        (0, 'K', 's', 1, NULL), (0, 'K', 'u', 2, NULL), (1, 'K', 'u', 2, NULL), (2, 'K', 'a', 3, NULL), (3, 'K', 'u', 2, NULL),
        (0, 'R', NULL, 2, 'user'), (1, 'R', NULL, 2, 'user'), (2, 'R', NULL, 3, 'assistant'), (3, 'R', NULL, 2, 'user'),
        (0, 'D', NULL, 0, NULL), (1, 'D', NULL, 1, NULL), (2, 'D', NULL, 2, NULL), (3, 'D', NULL, 3, NULL)),
    paths AS (
        SELECT conv_id, 0::bigint AS i, 0 AS state, struct_pack(cost := 0::bigint, audit := '', lines := []::varchar[]) AS best FROM counts
        UNION ALL
        SELECT p.conv_id, r.i, e.reached, min(struct_pack(
                   cost := p.best.cost + 3 * length(n.audit) + CASE e.edit WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
                           + CASE WHEN r.fault = 'truncated' AND e.edit <> 'D' THEN 3 ELSE 0 END,
                   audit := p.best.audit || n.audit || e.edit,
                   lines := p.best.lines || n.lines || CASE WHEN e.edit = 'D' THEN []::varchar[] ELSE [coalesce(e.role, r.role) || ':' || r.text] END))
        FROM paths p JOIN judged r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1 JOIN inserts n ON n.state = p.state
             JOIN edits e ON e.state = n.reached AND (e.edit = 'D' OR r.fault IN ('none', 'truncated')) AND (e.edit <> 'K' OR e.initial = r.initial)
        GROUP BY p.conv_id, r.i, e.reached),
    ended AS (
        SELECT p.conv_id, min(struct_pack(cost := p.best.cost + 3 * length(n.audit), audit := p.best.audit || n.audit, lines := p.best.lines || n.lines)) AS best
        FROM paths p JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.i JOIN inserts n ON n.state = p.state AND n.reached IN (0, 3)
        GROUP BY p.conv_id)
    SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, coalesce(e.best.cost, 0) AS cost, coalesce(e.best.audit, '') AS audit,
           sha256(coalesce(array_to_string(e.best.lines, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
         LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM a.conv_id"""


@query("op12_conversation_repair", OP12_SQL)
def op12(spark, table):
    """Faults of every damaged conversation, and the cheapest edits that mend it."""
    return conversations.repair_report(conversations.damage(table("conversations")), table("conversations"))


OP13_SQL = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::bigint AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, rank::int AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) t WHERE rank <= 5"""


@query("op13_exact_top_k", OP13_SQL)
def op13(spark, table):
    """The five vectors of the highest inner product for every fiftieth vector."""
    return topk.exact_top_k(table("embeddings"), lambda i: i % 50 == 0, k=5)
