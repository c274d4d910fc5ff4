"""URL filters: allow and block rules, and a logistic regression on hashed character n-grams of host and path.

The regression is trained with Spark ML from a small table of labelled URLs; scoring works within the row, so no
page is shuffled. Rules come first, the regression judges what no rule fits.
"""

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fieldlens.llm.common import keep

BUCKETS = 1 << 16
GRAM_SIZES = (3, 4, 5)
# The labelled table holds as many urls to block as to allow, a crawl far fewer: more than even odds are asked for.
BLOCK_FROM = 0.65

# Own examples: hosts and paths of the kinds that a crawl keeps away from, and ordinary ones.
BLOCKED = (
    "http://www.casino-royal.example.com/en/bonus", "http://bestcasino.example.net/slots/12", "https://m.online-casino.example.org/win",
    "http://bigwin-casino.example.com/de/41", "http://poker-win.example.net/en/889", "https://freebets.example.com/odds",
    "http://sports-bets.example.org/fr/3", "http://bet-now.example.net/en/77", "https://www.free-bets-daily.example.com/es/5",
    "http://cheap-pills.example.com/buy", "http://pills-online.example.net/en/10", "http://cheap-meds.example.org/pills/4",
    "https://buy-pills.example.com/de/9", "http://www.cheap-viagra.example.net/order", "http://adult-video.example.com/en/71",
    "https://adult-chat.example.net/fr/8", "http://www.adult-x-videos.example.org/es/18", "http://xxx-adult.example.com/watch",
    "http://porn-tube.example.net/en/6", "http://spam-link.example.com/en/1", "https://link-farm.example.net/de/2",
    "http://www.spam-blog.example.org/fr/33", "http://seo-farm.example.com/en/spam", "http://content-farm.example.net/en/4711",
    "http://ads-server.example.com/track?id=5", "https://ad-track.example.net/pixel", "http://m.track-clicks.example.org/en/12",
    "http://tracker-ads.example.com/es/1", "http://www.popup-ads.example.net/fr/2", "http://quick-loans.example.com/apply",
    "https://payday-loan.example.net/en/5", "http://crack-download.example.org/warez", "http://free-warez.example.com/en/99",
    "http://torrent-crack.example.net/de/7", "http://win-prize.example.com/en/claim", "https://free-prize-win.example.org/fr/12",
    "http://lottery-win.example.net/es/3", "http://hot-singles.example.com/en/chat", "https://replica-watch.example.net/buy/1",
    "http://miracle-diet.example.org/en/pills",
)
ALLOWED = (
    "http://www.university.example.com/en/courses", "http://citylibrary.example.net/catalogue/12", "https://m.daily-news.example.org/today",
    "http://museum-arts.example.com/de/41", "http://weather-report.example.net/en/889", "https://cooking.example.com/recipes",
    "http://garden-notes.example.org/fr/3", "http://history-now.example.net/en/77", "https://www.science-daily.example.com/es/5",
    "http://open-source.example.com/docs", "http://teachers-online.example.net/en/10", "http://public-health.example.org/guides/4",
    "https://travel-notes.example.com/de/9", "http://www.parliament.example.net/order", "http://school-video.example.com/en/71",
    "https://language-forum.example.net/fr/8", "http://www.mathematics.example.org/es/18", "http://the-theatre.example.com/watch",
    "http://nature-pictures.example.net/en/6", "http://blog.engineer.example.com/en/1", "https://river-valley.example.net/de/2",
    "http://www.thinking.example.org/fr/33", "http://the-other.example.com/en/news", "http://thirteen.example.net/en/4711",
    "http://mail-server.example.com/help?id=5", "https://together.example.net/picture", "http://m.another.example.org/en/12",
    "http://there-and-then.example.com/es/1", "http://www.weekend-reader.example.net/fr/2", "http://quick-start.example.com/apply",
    "https://insurance.example.net/en/5", "http://the-download.example.org/manual", "http://freedom.example.com/en/99",
    "http://nation-and-station.example.net/de/7", "http://winter.example.com/en/season", "https://thread.example.org/fr/12",
    "http://windows-help.example.net/es/3", "http://hot-springs.example.com/en/visit", "https://bird-watch.example.net/list/1",
    "http://healthy-diet.example.org/en/plans",
)
LABELLED = tuple((u, 1) for u in BLOCKED) + tuple((u, 0) for u in ALLOWED)


def with_host_path(pages, url="url"):
    """The table with host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.withColumn("host", host).withColumn("path", F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def rule_of(rules, host="host", path="path"):
    """Struct (rule, verdict) of the longest fitting rule, or null; ``rules``: (verdict, ``domain/path prefix``) pairs.

    A rule fits its host and all subdomains if the path starts with the rule's. A list of some hundred rules is meant; of
    rules of the same length the first one wins.
    """
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        domain, _, prefix = rule.partition("/")
        fit = ((F.col(host) == domain) | F.endswith(F.col(host), F.lit("." + domain))) & F.startswith(F.col(path), F.lit("/" + prefix))
        fits.append(F.when(fit, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def grams(column, mark, sizes=GRAM_SIZES):
    """SQL of the array of a text's character n-grams, lower-cased and framed by blanks, each behind ``mark``.

    Shifted arrays are zipped, so the work grows with the text's length whatever that is.
    """
    chars = f"array_remove(split(concat(' ', lower({column}), ' '), ''), '')"
    found, parts = chars, []
    for n in range(2, max(sizes) + 1):
        found = f"zip_with({found}, slice({chars}, {n}, greatest(size({chars}) - {n - 1}, 0)), (a, b) -> concat(a, b))"
        if n in sizes:
            parts.append(f"array_compact({found})")
    return f"transform(concat({', '.join(parts)}), g -> concat('{mark}', g))"


def with_grams(frame, host="host", path="path"):
    return frame.withColumn("grams", F.expr(f"concat({grams(host, 'h')}, {grams(path, 'p')})"))


def train(labelled, url="url", label="label", buckets=BUCKETS, regularisation=0.001):
    """Fitted Spark ML pipeline: hashed counts of the n-grams, scaled to length one, into a logistic regression.

    ``labelled`` is a small table of urls with label 1 (block) or 0 (allow); rows without url or label are left out.
    """
    rows = with_grams(with_host_path(keep(labelled, url, label).dropna(), url))
    return Pipeline(stages=[
        HashingTF(inputCol="grams", outputCol="counts", numFeatures=buckets),
        Normalizer(inputCol="counts", outputCol="features"),
        LogisticRegression(labelCol=label, maxIter=100, regParam=regularisation, standardization=False),
    ]).fit(rows.coalesce(1))


def filter_urls(pages, rules, labelled=None, url="url", page_id="page_id", threshold=BLOCK_FROM):
    """One row per row of ``pages``: page_id, host, path, rule (null if none fits), verdict (allow or block: the rule's, else
    block if the regression gives ``threshold`` or more), score (the regression's, 0 to 1).

    ``labelled`` is the training table (url, label), by default the own examples of this module. A null url, or one without
    ``://``, has an empty host and path, fits no rule that names a host and is judged by the frame
    of blanks alone. Null ids and repeated
    rows are judged each; other columns aren't read; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    if labelled is None:
        labelled = spark.createDataFrame(LABELLED, "url string, label int")
    found = with_host_path(keep(pages, page_id, url), url).withColumn("__rule", rule_of(rules))
    scored = train(labelled).transform(with_grams(found))
    judged = scored.select(page_id, "host", "path", "__rule", F.get(vector_to_array("probability"), F.lit(1)).alias("score"))
    verdict = F.coalesce(F.col("__rule.verdict"), F.when(F.col("score") >= threshold, "block").otherwise("allow"))
    return judged.select(page_id, "host", "path", F.col("__rule.rule").alias("rule"), verdict.alias("verdict"), "score")
