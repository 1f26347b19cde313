"""URL filters: fixed rules first, then association rules mined from URLs of known verdict.

A URL becomes a set of tokens: the words of its host and of its path. FP-growth finds the
combinations of tokens that recur among the URLs of known verdict, together with a verdict. A
combination whose share of that verdict (confidence) and of all URLs (support) are large enough is
a rule, unless a shorter one does as well. FP-growth lists every subset of a URL's tokens; where
URLs have too many for that, patterns are grown token by token instead, and only those that no
shorter one makes idle. Both find the same rules. Rules are held in an inverted index under their rarest
token. A URL is reduced to the tokens that rules use; each distinct reduced set looks up its
tokens, keeps the rules it contains whole, and takes the verdict of the best.

Everything is built-in column functions, joins and Spark's own FP-growth.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpulse.llm.common import Scratch, plain_text
from shelfpulse.llm.skew import heavy_keys, salted_join

Rule = tuple[str, str, str]  # verdict, host, path

#: The rules of the contract.
RULES: tuple[Rule, ...] = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
VERDICTS = ("allow", "block")
#: Verdict of a URL that no rule of either kind fits.
DEFAULT = "allow"
#: A mined rule holds in at least this share, and this number, of the URLs of known verdict ...
MIN_SUPPORT = 0.002
MIN_URLS = 5
#: ... and at least this share of the URLs it fits have its verdict.
MIN_CONFIDENCE = 0.7
#: Spark's FP-growth lists all subsets of a URL's frequent tokens. It mines the URLs of known verdict
#: if none has more frequent tokens than this; if one has, `_grown` mines them, with all their tokens.
MAX_MINED_TOKENS = 14

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ROW = "_url_row"


def parts(url: str) -> tuple[Column, Column]:
    """Host, in lower case A-Z, and path of a URL column; both empty without `://`."""
    text = plain_text(url)
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def fixed_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls. A rule fits its host and every
    subdomain of it where the path starts with the rule's; of equally long ones the first in
    order of host, path and verdict wins."""
    rule = verdict = F.lit(None).cast("string")
    for says, name, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2], r[0]), reverse=True):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule = F.when(fits, name + start).otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return rule, verdict


def tokens(host: Column, path: Column) -> Column:
    """The distinct words of host and path, marked with where they stand."""

    def words(text: Column, mark: str) -> Column:
        found = F.filter(F.split(F.translate(text, _UPPER, _LOWER), "[-./_:@%=&+,;~!]+"), lambda w: w != "")
        return F.transform(found, lambda w: F.concat(F.lit(mark), w))

    return F.array_distinct(F.concat(words(host, "host:"), words(path, "path:")))


def _frequent(exploded: DataFrame, total: int, least: int) -> DataFrame:
    """Tokens in at least the least number of URLs, but not in all, with `n` and `blocked`, how many
    URLs have them and how many of these are blocked. Of tokens that occur in exactly the same
    URLs one is kept, since rules cannot tell them apart."""
    block = (F.col("verdict") == VERDICTS[1]).cast("long")
    same = [F.bit_xor(F.xxhash64(F.lit(i), _ROW)).alias(f"same{i}") for i in range(2)]
    counted = exploded.groupBy("token").agg(F.count("*").alias("n"), F.sum(block).alias("blocked"), *same)
    counted = counted.filter((F.col("n") >= least) & (F.col("n") < total))
    one = counted.groupBy("n", "blocked", "same0", "same1").agg(F.min("token").alias("token"))
    return one.select("token", "n", "blocked")


def mine(
    labelled: DataFrame,
    scratch: Scratch,
    min_support: float = MIN_SUPPORT,
    min_urls: int = MIN_URLS,
    min_confidence: float = MIN_CONFIDENCE,
    max_tokens: int = MAX_MINED_TOKENS,
) -> DataFrame:
    """Rules from rows of tokens (array) and verdict (allow or block): tokens, verdict,
    confidence, support (rows that the rule is right about) and `first`, its rarest token. Rows
    without tokens or with another verdict teach nothing."""
    known = labelled.filter(F.col("verdict").isin(*VERDICTS)).select("tokens", "verdict")
    known = scratch.table(known.withColumn(_ROW, F.monotonically_increasing_id()), "labelled-urls")
    total = known.count()
    if not total:
        return _no_rules(known)

    exploded = known.select(_ROW, "verdict", F.explode("tokens").alias("token"))
    least = max(min_urls, math.ceil(min_support * total))
    frequent = scratch.table(_frequent(exploded, total, least), "frequent-tokens")
    heavy = heavy_keys(frequent, ["token"])
    kept = salted_join(exploded, frequent, ["token"], heavy, F.xxhash64(_ROW))
    baskets = kept.groupBy(_ROW, "verdict").agg(F.collect_list(F.struct("n", "token", "blocked")).alias("items"))
    baskets = scratch.table(baskets, "baskets")
    longest = baskets.agg(F.max(F.size("items"))).first()[0]
    if longest is None:
        return _no_rules(known)
    mined = _listed(baskets, scratch, least) if longest <= max_tokens else _grown(baskets, frequent, scratch, least)
    rules = mined.withColumn("confidence", F.col("support") / F.col("n")).filter(F.col("confidence") >= min_confidence)
    rules = scratch.table(rules.select("tokens", "verdict", "confidence", "support"), "rules")
    return _pruned(rules, frequent)


def _listed(baskets: DataFrame, scratch: Scratch, least: int) -> DataFrame:
    """All combinations of tokens that occur with a verdict in at least the least number of
    baskets: tokens (in order), verdict, support (with that verdict) and n."""
    label = F.array(F.concat(F.lit("="), F.col("verdict")))
    baskets = scratch.table(baskets.select(F.concat("items.token", label).alias("items")), "labelled-baskets")
    # The share that stands for this number; half of one is taken off because of rounding.
    share = min(1.0, (least - 0.5) / baskets.count())
    sets = FPGrowth(itemsCol="items", minSupport=share).fit(baskets).freqItemsets
    sets = scratch.table(sets.select(F.array_sort("items").alias("items"), F.col("freq").alias("n")), "itemsets")

    marks = [f"={v}" for v in VERDICTS]
    is_mark = F.exists("items", lambda x: x.isin(*marks))
    holds = sets.filter(is_mark & (F.size("items") > 1)).select(
        F.filter("items", lambda x: ~x.isin(*marks)).alias("tokens"),
        F.filter("items", lambda x: x.isin(*marks))[0].alias("mark"),
        F.col("n").alias("support"),
    )
    fits = sets.filter(~is_mark).select(F.col("items").alias("tokens"), "n")
    return holds.join(fits, "tokens").select("tokens", F.substr("mark", F.lit(2)).alias("verdict"), "support", "n")


def _grown(baskets: DataFrame, frequent: DataFrame, scratch: Scratch, least: int) -> DataFrame:
    """Like `_listed`, without combinations that `_pruned` would drop for certain: those that
    occur in as many baskets without one of their tokens, and those that hold a smaller one of a
    single verdict. A smaller one is then as sure. Both pass on to everything larger, so a
    combination is tried only if all that lack one of its tokens are left and open.

    Patterns grow by one token a round, from the rarest token to the most frequent. Rows are
    pairs of an open pattern and a distinct basket with it, dealt by the pattern in the joins."""
    rows, blocked = F.col("rows"), F.col("blocked")
    often = F.greatest(blocked, rows - blocked) >= least
    is_open = (blocked > 0) & (blocked < rows)
    item = F.struct("n", "token")
    singles = frequent.select(F.array(item).alias("pattern"), F.col("n").alias("rows"), "blocked")
    levels = [scratch.table(singles.filter(often), "patterns")]

    def may_grow(x: Column) -> Column:
        lots = F.greatest(x["blocked"], x["n"] - x["blocked"]) >= least
        return lots & (x["blocked"] > 0) & (x["blocked"] < x["n"])

    open_items = F.transform(F.filter("items", may_grow), lambda x: F.struct(x["n"].alias("n"), x["token"].alias("token")))
    distinct = (
        baskets.select(F.sort_array(open_items).alias("rest"), (F.col("verdict") == VERDICTS[1]).cast("long").alias("block"))
        .groupBy("rest").agg(F.count("*").alias("rows"), F.sum("block").alias("blocked"))
    )
    empty = F.slice("rest", 1, 0)
    held = distinct.select(F.monotonically_increasing_id().alias("basket"), empty.alias("pattern"), "rest", "rows", "blocked")
    held = scratch.table(held, "held-patterns")

    def longer() -> DataFrame:
        """Every held pattern with one more token of its basket, behind its last."""
        each = held.select("*", F.posexplode("rest").alias("at", "item"))
        behind = F.slice("rest", F.col("at") + 2, F.size("rest"))
        pattern = F.concat("pattern", F.array("item"))
        return each.select("basket", pattern.alias("pattern"), behind.alias("rest"), "rows", "blocked")

    def counted() -> DataFrame:
        sums = [F.sum("rows").alias("rows"), F.sum("blocked").alias("blocked"), F.count("*").alias("n")]
        return scratch.table(longer().groupBy("pattern").agg(*sums), "longer-patterns")

    counts = counted()
    while True:
        going = levels[-1].filter(is_open)
        if going.isEmpty():
            break
        heavy = heavy_keys(counts, ["pattern"])
        grown = salted_join(longer(), going.select("pattern"), ["pattern"], heavy, F.xxhash64("basket"), "left_semi")
        grown = scratch.table(grown.filter(F.size("rest") > 0), "held-patterns")
        scratch.discard(held)
        held = grown
        counts = counted()

        found = counts.filter(often).drop("n")
        without = F.transform("pattern", lambda x: F.filter("pattern", lambda y: y != x))
        lacking = found.select("pattern", "rows", F.explode(without).alias("shorter"))
        before = going.select(F.col("pattern").alias("shorter"), F.col("rows").alias("before"))
        free = lacking.join(before, "shorter").filter("before > rows").groupBy("pattern").agg(F.count("*").alias("n_free"))
        free = free.filter(F.col("n_free") == F.size("pattern")).select("pattern")
        levels.append(scratch.table(found.join(free, "pattern", "left_semi"), "patterns"))

    sets = reduce(DataFrame.unionByName, levels)
    supports = [F.struct(F.lit(VERDICTS[0]).alias("verdict"), (rows - blocked).alias("support"))]
    supports += [F.struct(F.lit(VERDICTS[1]).alias("verdict"), blocked.alias("support"))]
    tokens_of = F.array_sort("pattern.token").alias("tokens")
    both = sets.select(tokens_of, rows.alias("n"), F.explode(F.array(*supports)).alias("of"))
    return both.select("tokens", "of.verdict", "of.support", "n").filter(F.col("support") >= least)


def _no_rules(known: DataFrame) -> DataFrame:
    fields = {"tokens": "array<string>", "verdict": "string", "confidence": "double", "support": "bigint", "first": "string"}
    return known.limit(0).select(*(F.lit(None).cast(kind).alias(name) for name, kind in fields.items()))


def _pruned(rules: DataFrame, frequent: DataFrame) -> DataFrame:
    """Rules none of whose tokens can be left out without losing confidence, and their rarest
    token."""
    shorter = rules.select(
        F.col("tokens").alias("longer"),
        "verdict",
        "confidence",
        F.explode(F.transform("tokens", lambda t: F.array_remove("tokens", t))).alias("tokens"),
    )
    better = rules.select("tokens", "verdict", F.col("confidence").alias("as_good"))
    idle = shorter.join(better, ["tokens", "verdict"]).filter("as_good >= confidence")
    left = rules.join(idle.select(F.col("longer").alias("tokens"), "verdict").distinct(), ["tokens", "verdict"], "left_anti")
    rarest = (
        left.select("tokens", F.explode("tokens").alias("token")).distinct().join(frequent.select("token", "n"), "token")
        .groupBy("tokens").agg(F.min(F.struct("n", "token"))["token"].alias("first"))
    )
    return left.join(rarest, "tokens")


def best_rules(rows: DataFrame, rules: DataFrame, scratch: Scratch) -> DataFrame:
    """rows: `_url_row` and tokens. The verdict of the best rule for every row that a rule fits:
    the most confident, then the best supported, then the shortest, then the first by its tokens."""
    used = rules.select(F.explode("tokens").alias("token")).distinct()
    exploded = rows.select(_ROW, F.explode("tokens").alias("token"))
    # Few distinct tokens of rules: their rows are counted to see which hold a large share.
    counts = scratch.table(
        exploded.groupBy("token").agg(F.count("*").alias("n")).join(used, "token", "left_semi"), "token-counts"
    )
    heavy = heavy_keys(counts, ["token"])
    kept = salted_join(exploded, used, ["token"], heavy, F.xxhash64(_ROW), "left_semi")
    reduced = kept.groupBy(_ROW).agg(F.array_sort(F.collect_list("token")).alias("held"))
    reduced = scratch.table(reduced, "reduced-urls")

    sets = scratch.table(reduced.groupBy("held").agg(F.count("*").alias("n")), "token-sets")
    found = sets.select("held", F.explode("held").alias("first")).join(rules, "first")
    found = found.filter(F.size(F.array_except("tokens", "held")) == 0)
    order = F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), F.size("tokens"), "tokens", "verdict")
    judged = found.groupBy("held").agg(F.min(order)["verdict"].alias("mined"))
    crowded = heavy_keys(sets, ["held"])
    return salted_join(reduced, judged, ["held"], crowded, F.xxhash64(_ROW)).select(_ROW, "mined")


def judge(pages: DataFrame, scratch: Scratch, rules: tuple[Rule, ...] = RULES, **mining) -> DataFrame:
    """`page_id`, host, path, rule and verdict of every row of `pages` (page_id, url).

    The URLs that a fixed rule judges are those of known verdict; the rest get the verdict of
    the best mined rule, or `DEFAULT`. A null URL or one without `://` has an empty host and
    path, which no rule fits. Rows with equal or null page_id are judged each by its own URL;
    further columns are left out. Without rows to learn from, the verdict is `DEFAULT`.
    """
    host, path = parts("url")
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    known = split.select("*", rule.alias("rule"), verdict.alias("verdict"))
    known = scratch.table(known.withColumn(_ROW, F.monotonically_increasing_id()), "urls")
    with_tokens = known.withColumn("tokens", tokens(F.col("host"), F.col("path")))
    mined = scratch.table(mine(with_tokens, scratch, **mining), "url-rules")
    unknown = with_tokens.filter("verdict IS NULL").select(_ROW, "tokens")
    best = best_rules(unknown, mined, scratch)
    says = reduce(lambda a, b: F.coalesce(a, b), [F.col("verdict"), F.col("mined"), F.lit(DEFAULT)])
    return known.join(best, _ROW, "left").select("page_id", "host", "path", "rule", says.alias("verdict"))
