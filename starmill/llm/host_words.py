"""URL filter: rules first, then words found inside host names, scored by naive Bayes.

Host names are split into words by the likeliest path over unigram counts of the pages' own words. The counts never
leave Spark: each distinct name meets the words it holds in a join, so neither the dictionary nor the names have to fit
anywhere. The classifier learns from the URLs the rules decide and judges the rest. Its weights are whole millionths,
so sums do not depend on their order.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.common import batch, map_arrow, table
from starmill.workspace import materialize

#: Letters of the longest word a name is split into, and of the longest host name there can be.
LONGEST, NAME = 24, 253
#: Distinct words a counting task holds before it passes them on.
HELD = 1 << 18

# The rules of the query, and what parts of an URL hold letters or digits.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUNS = r"([^\x00-\x60\x7B-\x7F]+|[0-9]+)"
TAG = re.compile(rb"<[^<>]*>")
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark or hash, with A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruling(rules: list[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def word_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """(word, n) over whole texts without their tags; tasks add up before anything is shuffled."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            found = [(w.decode(), n) for w, n in held.items()]
            found = [(w, n) for w, n in found if len(w) <= LONGEST]
            held.clear()
            return batch(schema, word=[w for w, _ in found], n=[n for _, n in found])

        for x in batches:
            for text in x.column(0):
                held.update(TAG.sub(b" ", text.as_py().encode()).translate(LETTERS).split())
                if len(held) >= HELD:
                    yield flush()
        yield flush()

    rows = texts.select(F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    return map_arrow(rows, task, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def segment(name: str, found: dict[tuple[int, int], int], total: int) -> list[str]:
    """The likeliest words of a name; ``found`` has the counts of those the corpus knows, by place and length.

    A piece of k letters that no text holds counts as 10 / 10^k. Of equally likely splits the one whose last word is
    longest stays.
    """
    best, cut = [0.0], [0]
    for end in range(1, len(name) + 1):
        options = []
        for k in range(1, min(LONGEST, end) + 1):
            n = found.get((end - k, k))
            options.append((best[end - k] + (math.log(n) if n else math.log(10) * (1 - k)) - math.log(max(total, 1)), k))
        top = max(options)
        best.append(top[0])
        cut.append(top[1])
    words, end = [], len(name)
    while end:
        words.append(name[end - cut[end]:end])
        end -= cut[end]
    return words[::-1]


def split_names(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) of distinct names.

    Every piece of a name meets the counts in a join by the piece; a name's own pieces, at most ``LONGEST`` for each of
    its letters, then come together. A run of more letters than a host name may have is no name and stays one word.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    starts = names.where(F.length("name") <= NAME).select(
        "name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("start")
    )
    most = F.least(F.lit(LONGEST), F.length("name") - F.col("start") + 1)
    pieces = starts.select("name", "start", F.explode(F.sequence(F.lit(1), most)).alias("size"))
    pieces = pieces.withColumn("word", F.expr("substring(name, start, size)"))
    known = pieces.join(counts, "word").groupBy("name").agg(
        F.collect_list(F.struct((F.col("start") - 1).alias("start"), "size", "n")).alias("found")
    )
    schema = pa.schema([("name", pa.string()), ("words", pa.list_(pa.string()))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            out = []
            for r in x.to_pylist():
                found = {(f["start"], f["size"]): f["n"] for f in r["found"] or []}
                out.append(segment(r["name"], found, total) if len(r["name"]) <= NAME else [r["name"]])
            yield batch(schema, name=x.column("name"), words=out)

    return map_arrow(names.join(known, "name", "left"), task, "name string, words array<string>")


def runs_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(RUNS), 1)


def is_number(run: Column) -> Column:
    return run.rlike(r"\A[0-9]")


def host_tokens(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, token) of distinct hosts: words of all labels but the last, which a registry gave; numbers by length."""
    runs = hosts.select("host", F.explode(runs_of(F.regexp_replace("host", r"\.[^.]*\z", ""))).alias("name"))
    runs = materialize(runs, "host-names")
    words = split_names(runs.where(~is_number(F.col("name"))).select("name").distinct(), counts)
    named = runs.join(materialize(words, "name-words"), "name").select("host", F.explode("words").alias("token"))
    digits = runs.where(is_number(F.col("name"))).select("host", number_token(F.col("name")).alias("token"))
    return materialize(named.union(digits).select("host", F.concat(F.lit("host "), "token").alias("token")), "host-tokens")


def number_token(run: Column) -> Column:
    return F.concat(F.lit("#"), F.length(run).cast("string"))


def path_tokens(paths: DataFrame) -> DataFrame:
    """(path, token, …): runs of letters, lower-cased, and numbers by their length; other columns are carried along."""
    runs = paths.withColumn("token", F.explode(runs_of(F.translate("path", UPPER, LOWER))))
    token = F.when(is_number(F.col("token")), number_token(F.col("token"))).otherwise(F.col("token"))
    return runs.withColumn("token", F.concat(F.lit("path "), token))


def micro(ratio: Column) -> Column:
    """Logarithm in whole millionths."""
    return F.round(F.log(ratio) * 1_000_000).cast("long")


def learn(decided: DataFrame, of_host: DataFrame) -> tuple[DataFrame, int]:
    """(token, weight) and the prior of a multinomial naive Bayes model, both as log odds of block.

    ``decided`` has distinct (host, path) with ``block`` 1 or 0. Counts are added to one, over all tokens seen.
    """
    sides = [F.sum("block").alias("block"), F.sum(1 - F.col("block")).alias("allow")]
    by_host = decided.groupBy("host").agg(*sides).join(of_host, "host").select("token", "block", "allow")
    by_path = path_tokens(decided.groupBy("path").agg(*sides)).select("token", "block", "allow")
    seen = materialize(
        by_host.union(by_path).groupBy("token").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")),
        "url-tokens",
    )
    size, block, allow = seen.agg(F.count(F.lit(1)), F.sum("block"), F.sum("allow")).first()
    n_block, n_allow = decided.agg(*sides).first()
    prior = round(1_000_000 * math.log(((n_block or 0) + 1) / ((n_allow or 0) + 1)))
    odds = (F.col("block") + 1) * F.lit(float((allow or 0) + size)) / ((F.col("allow") + 1) * F.lit(float((block or 0) + size)))
    return seen.select("token", micro(odds).alias("weight")), prior


def judge(
    pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", text_col: str = "html"
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every page.

    ``rules`` are (block or allow, host/path); a rule fits its host and all subdomains where the path starts with the
    rule's, and the longest wins. Where none fits, a model that learned from the distinct URLs the rules decide says
    block if its log odds (``score``, in millionths; null where a rule decides) are above 0. Tokens it never saw say
    nothing. Nulls and URLs without ``://`` have an empty host and path, and so only the prior.
    """
    url = F.col(url_col).cast("string")
    parsed = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = ruling(rules, F.col("host"), F.col("path"))
    parsed = materialize(parsed.withColumns({"rule": rule, "verdict": verdict}), "urls")
    urls = materialize(parsed.select("host", "path", "verdict").distinct(), "urls")
    of_host = host_tokens(urls.select("host").distinct(), materialize(word_counts(pages, text_col), "word-counts"))
    decided = urls.where("verdict IS NOT NULL").select("host", "path", (F.col("verdict") == "block").cast("long").alias("block"))
    weights, prior = learn(decided, of_host)
    weights = materialize(weights, "url-weights")
    open_urls = urls.where("verdict IS NULL")
    hosts = (
        open_urls.select("host").distinct().join(of_host, "host").join(weights, "token")
        .groupBy("host").agg(F.sum("weight").alias("host_score"))
    )
    paths = (
        path_tokens(open_urls.select("path").distinct()).join(weights, "token")
        .groupBy("path").agg(F.sum("weight").alias("path_score"))
    )
    scored = (
        parsed.where("verdict IS NULL").drop("verdict").join(hosts, "host", "left").join(paths, "path", "left")
        .withColumn("score", F.lit(prior) + F.coalesce("host_score", F.lit(0)) + F.coalesce("path_score", F.lit(0)))
        .withColumn("verdict", F.when(F.col("score") > 0, "block").otherwise("allow"))
    )
    columns = ["page_id", "host", "path", "rule", "verdict", F.col("score").cast("long").alias("score")]
    return scored.select(*columns).union(
        parsed.where("verdict IS NOT NULL").withColumn("score", F.lit(None).cast("long")).select(*columns)
    )


def op12_host_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the urls of all pages."""
    return judge(table(spark, sf_dir, "pages"), RULES)


QUERIES = {"op12_host_words": (op12_host_words, None)}
