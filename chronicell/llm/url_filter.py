"""URL filter: rules first; where none fits, multinomial naive Bayes over words that unigram Viterbi finds in the URL.

Nothing labels URLs, so the classifier is trained on weak labels: a URL counts as one to block when a word of its
segmented host is a seed word, and what goes along with those words in hosts and paths is learned from all pages: a host
without a seed word is blocked if its other words are mostly found beside seed words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronicell.llm.base import materialize, table

#: (verdict, rule): the host that the rule is for, with all subdomains, then the start of the path.
RULES = (
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("allow", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
)
# Seed words by kind of site: gambling, adult, pharmacy spam, malware and phishing, advertising and tracking.
BLOCK_WORDS = (
    "bet", "bets", "betting", "blackjack", "bookmaker", "casino", "casinos", "gambling", "jackpot", "lottery", "poker", "roulette", "slots", "wager",
    "adult", "camgirl", "escort", "hentai", "nsfw", "porn", "porno", "sex", "xxx",
    "cialis", "pharmacy", "pills", "steroids", "viagra",
    "crack", "keygen", "malware", "phishing", "ransomware", "spyware", "trojan", "virus", "warez",
    "ad", "ads", "adserver", "advert", "banner", "clickbait", "popup", "spam", "track", "tracker", "tracking",
)
#: Seed words have at least this share of all occurrences in the lexicon.
MIN_SHARE = 1e-5
#: Words of the lexicon that are longer count as unknown. Runs of letters are cut to pieces of so many (a host has at
#: most 253), each of which is segmented whole, so that a run's parts stay in proportion to its length.
MAX_WORD, MAX_RUN = 40, 256
_HELD = 50_000  # parts of runs that a worker holds before it sends them on


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is tested first, being wrapped last
        own, slash, start = text.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


@dataclass
class Lexicon:
    """Unigram model: the cost of a word is minus the logarithm of its share; unknown words cost more the longer."""

    cost: dict[str, float]
    total: float

    def unknown(self, length: int) -> float:
        return log(self.total + 1) + length * log(10)

    def segment(self, name: str) -> list[str]:
        """The words of least total cost (Viterbi; of equal ones, the split whose last word is longest)."""
        best, cut = [0.0], [0]
        for end in range(1, len(name) + 1):
            low, at = float("inf"), end - 1
            for start in range(max(0, end - MAX_WORD), end):
                c = self.cost.get(name[start:end])
                c = best[start] + (self.unknown(end - start) if c is None else c)
                if c < low:
                    low, at = c, start
            best.append(low)
            cut.append(at)
        words, end = [], len(name)
        while end:
            words.append(name[cut[end] : end])
            end = cut[end]
        return words[::-1]


def page_words(pages: DataFrame) -> DataFrame:
    """(word, n): the words of the pages' visible text, counted over all pages."""
    text = F.lower(F.regexp_replace(F.coalesce("html", F.lit("")), "<[^>]*>", " "))
    words = pages.select(F.explode_outer(F.split(text, r"[^\p{L}]+", -1)).alias("word"))
    return words.filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


_SPLIT = re.compile(r"[\W\d_]+")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the delimited runs of letters of the host and of the path."""
    for batch in batches:
        found = [pa.array([[run[k : k + MAX_RUN] for run in _SPLIT.split(x.lower()) for k in range(0, len(run), MAX_RUN)] for x in batch.column(c).to_pylist()], pa.list_(pa.string())) for c in ("host", "path")]
        yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*batch.schema.names, "host_runs", "path_runs"])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs, words = [], []
        for run in batch.column("run").to_pylist():
            parts = {run[k:end] for end in range(1, len(run) + 1) for k in range(max(0, end - MAX_WORD), end)}
            runs += [run] * len(parts)
            words += parts
            if len(words) >= _HELD:
                yield pa.RecordBatch.from_arrays([pa.array(runs, pa.string()), pa.array(words, pa.string())], names=["run", "word"])
                runs, words = [], []
        yield pa.RecordBatch.from_arrays([pa.array(runs, pa.string()), pa.array(words, pa.string())], names=["run", "word"])


def _segments(total: float, extra: Sequence[str], share: float):
    least = dict.fromkeys(extra, -log(share))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = []
            for name, found in zip(batch.column("run").to_pylist(), batch.column("found").to_pylist()):
                cost = least | {x["word"]: min(-log(x["n"] / total), least.get(x["word"], float("inf"))) for x in found or ()}
                words.append(Lexicon(cost, total).segment(name))
            weak = [any(w in extra for w in x) for x in words]
            yield pa.RecordBatch.from_arrays([batch.column("run"), pa.array(words, pa.list_(pa.string())), pa.array(weak, pa.bool_())], names=["run", "words", "weak"])

    return run


def segment_runs(runs: DataFrame, counts: DataFrame, extra: Sequence[str] = BLOCK_WORDS, share: float = MIN_SHARE) -> DataFrame:
    """(run, words, weak: whether one of them is in ``extra``) for different runs (run), by the full counts (word, n).

    The parts of a run that may be words are looked up by a join, so the lexicon may have any size. ``extra`` words are
    in the lexicon with a share of at least ``share``.
    """
    total = float(counts.agg(F.sum("n")).first()[0] or 0)
    parts = runs.select("run").mapInArrow(_candidates, "run string, word string")
    known = parts.join(counts.filter(F.length("word") <= MAX_WORD), "word")
    found = known.groupBy("run").agg(F.collect_list(F.struct("word", "n")).alias("found"))
    return runs.select("run").join(found, "run", "left").mapInArrow(_segments(total, extra, share), "run string, words array<string>, weak boolean")


@dataclass
class NaiveBayes:
    """Log odds of block against allow: a prior and one term for each token occurrence.

    ``terms`` is a table (t, term) of all tokens; a token that was never seen says nothing.
    """

    prior: float
    terms: DataFrame

    def log_odds(self, tokens: Sequence[str]) -> float:
        found = {r.t: r.term for r in self.terms.filter(F.col("t").isin(sorted(set(tokens)))).collect()}
        return self.prior + sum(found.get(t, 0.0) for t in tokens)


def naive_bayes(n: int, block: int, counts: DataFrame) -> NaiveBayes:
    """From the numbers of URLs and of those to block, and (t, block, allow): a token's occurrences in both.

    Each token gets two occurrences more, shared out to the classes as all occurrences are. (One in each would make every
    rare token evidence for the smaller class, so that clean URLs of uncommon words were blocked.)
    """
    sums = counts.agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")).first()
    in_block, in_allow = (sums.block or 0) + 1, (sums.allow or 0) + 1
    more_block, more_allow = 2 * in_block / (in_block + in_allow), 2 * in_allow / (in_block + in_allow)
    term = F.log(F.col("block") + more_block) - F.log(F.col("allow") + more_allow) - log(in_block / in_allow)
    return NaiveBayes(log((block + 1) / (n - block + 1)), counts.select("t", term.alias("term")))


def fit_naive_bayes(tokens: DataFrame) -> NaiveBayes:
    """From (tokens array<string>, weak_block boolean), counted over all rows."""
    rows = tokens.agg(F.count("*").alias("n"), F.coalesce(F.count_if("weak_block"), F.lit(0)).alias("block")).first()
    each = tokens.select(F.explode_outer("tokens").alias("t"), "weak_block").filter("t IS NOT NULL")
    counts = each.groupBy("t").agg(F.count_if("weak_block").alias("block"), F.count_if(~F.col("weak_block")).alias("allow"))
    return naive_bayes(rows.n, rows.block, materialize(counts, "url-token-counts"))


def _sum(values: Column) -> Column:
    """Of an array, smallest first: equal arrays have equal sums, however they were gathered."""
    return F.aggregate(F.sort_array(values), F.lit(0.0), lambda a, x: a + x)


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, block_words: Sequence[str] = BLOCK_WORDS) -> DataFrame:
    """page_id, host, path, rule, verdict, log_odds; one row for each row of ``pages`` (page_id, url, html).

    verdict is the rule's where one fits, else block where the log odds are above 0, else allow. Null urls and urls
    without :// have an empty host and path and no words. Null html adds no words to the lexicon. Repeated rows are
    judged alike; an empty table gives no rows; other columns are ignored. Very long urls are segmented in whole, runs of
    over MAX_RUN letters in pieces.

    Different runs of letters are segmented and scored once; lexicon and tokens are joined in full.
    """
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.monotonically_increasing_id().alias("_row"))
    cut = materialize(own.mapInArrow(_runs, "page_id bigint, host string, path string, _row bigint, host_runs array<string>, path_runs array<string>"), "url-runs", narrow=False)
    runs = cut.select(F.explode(F.concat("host_runs", "path_runs")).alias("run")).distinct()
    segmented = materialize(segment_runs(runs, materialize(page_words(pages), "url-lexicon"), block_words), "url-segments")

    hosts = cut.select("_row", F.explode("host_runs").alias("run"))
    weak = hosts.join(segmented.filter("weak").select("run"), "run").select("_row").distinct().withColumn("_weak", F.lit(True))
    labelled = materialize(cut.join(weak, "_row", "left").select("page_id", "host", "path", "_row", F.concat("host_runs", "path_runs").alias("runs"), F.coalesce("_weak", F.lit(False)).alias("weak_block")), "url-pages")
    rows = labelled.agg(F.count("*").alias("n"), F.count_if("weak_block").alias("block")).first()
    seen = labelled.select(F.explode("runs").alias("run"), "weak_block").groupBy("run").agg(F.count_if("weak_block").alias("block"), F.count_if(~F.col("weak_block")).alias("allow"))
    each = segmented.join(seen, "run").select(F.explode("words").alias("t"), "block", "allow")
    model = naive_bayes(rows.n, rows.block or 0, materialize(each.groupBy("t").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")), "url-token-counts"))

    terms = segmented.select("run", F.explode("words").alias("t")).join(model.terms, "t")
    scores = materialize(terms.groupBy("run").agg(_sum(F.collect_list("term")).alias("score")), "url-run-scores")
    found = labelled.select("_row", F.explode("runs").alias("run")).join(scores, "run")
    odds = found.groupBy("_row").agg(_sum(F.collect_list("score")).alias("_odds"))
    scored = labelled.join(odds, "_row", "left").withColumn("log_odds", F.lit(model.prior) + F.coalesce("_odds", F.lit(0.0)))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("log_odds") > 0, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "log_odds")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))
