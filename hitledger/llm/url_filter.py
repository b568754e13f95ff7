"""URL filtering by association rules, in DataFrame functions.

A URL becomes a set of tokens: host labels, path words, query keys.
Frequent-pattern growth over labelled URLs finds the token combinations that go
with a blocking label; those with enough support, confidence and lift become
rules, and a rule that a shorter one implies is dropped. Matching uses an
inverted index: each rule is filed under the rarest of its tokens, a URL meets
only the rules of its own tokens, and fires those whose tokens it has in full.

Explicit rules (host, path) come before the mined ones; the longest that fits wins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm.common import lower_ascii, saved, with_free_name

# More explicit rules than this would make the expression unwieldy.
MAX_EXPLICIT_RULES = 1000
_BLOCK = "label=block"


@dataclass(frozen=True)
class HostRule:
    """Fits a host and its subdomains where the path starts with `path`."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#`; A-Z in lower case; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to `?` or `#`; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """The distinct tokens of a URL: host labels, path words, query keys.

    Numbers are left out: as page numbers they say nothing about other pages.
    """
    host, path = url_host(url), url_path(url)
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))

    def parts(text: Column, pattern: str, mark: str) -> Column:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        return F.transform(found, lambda x: F.concat(F.lit(mark), x))

    everything = F.concat(
        parts(host, r"[^.:@]+", "h:"),
        parts(lower_ascii(path), r"[^/.\x2D_\d]{2,}", "p:"),
        parts(lower_ascii(query), r"(?<=^|&)[^=&]+", "q:"),
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(everything))


def mine_rules(
    labelled: DataFrame,
    min_support: float = 0.001,
    min_confidence: float = 0.7,
    min_lift: float = 1.5,
    max_tokens: int = 3,
    min_rows: int = 20,
) -> DataFrame:
    """Rules (tokens, confidence, lift, support) from rows of (url, blocked).

    Tokens that stand in exactly the same rows (the keys of one kind of link, say) are one item
    while patterns grow, and every choice of one token for each item is a rule afterwards: the
    same rules as without, and no pattern for each subset of such tokens. A token that the label
    goes with less often than the support asks for can be in no rule and is left out. What
    remains grows with the patterns of tokens that often, but not always, stand together.

    Each rule fills at least `min_support` of the rows; `min_rows` asks for evidence where there
    are few rows at all. Rows without a label or URL teach nothing, and an empty table has no
    rules. Of two rules where one has all tokens of the other and no more confidence, the shorter
    stays.
    """
    url_col, blocked_col = "url", "blocked"
    known = labelled.where(F.col(url_col).isNotNull() & F.col(blocked_col).isNotNull())
    rows = saved(
        known.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(blocked_col).alias("blocked"),
            url_tokens(F.col(url_col)).alias("tokens"),
        ),
        "url-rows",
    )
    n = rows.count()
    support = max(min_support, min(1.0, min_rows / max(1, n)))
    items = _items(rows, support * n)
    one = rows.select("row", "blocked", F.explode_outer("tokens").alias("token")).join(items, "token", "left")
    label = F.when(F.col("blocked"), F.array(F.lit(_BLOCK))).otherwise(F.array().cast("array<string>"))
    baskets = saved(
        one.groupBy("row", "blocked")
        .agg(F.collect_set("item").alias("items"))
        .select(F.concat("items", label).alias("items")),
        "url-baskets",
    )
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(baskets)
    grown = model.associationRules.where(
        (F.element_at("consequent", 1) == _BLOCK)
        & (F.size("antecedent") <= max_tokens)
        & (F.col("lift") >= min_lift)
    ).select("antecedent", "confidence", "lift", "support")
    found = _with_tokens(grown, items)
    rules = saved(found, "url-rules")
    shorter = rules.select(F.col("tokens").alias("s"), F.col("confidence").alias("c"))
    implied = (rules.confidence <= F.col("c")) & (F.size("s") < F.size(rules.tokens))
    # Both sides meet at a token they share, not in a product of all rules.
    left = rules.withColumn("_at", F.explode("tokens"))
    right = shorter.withColumn("_at", F.element_at("s", 1))
    weaker = left.join(right, "_at").where(
        implied & (F.size(F.array_except("s", left.tokens)) == 0)
    )
    return rules.join(weaker.select(left.tokens).distinct(), "tokens", "left_anti")


def _items(rows: DataFrame, least: float) -> DataFrame:
    """Columns token and item, the least of the tokens that stand in the same rows.

    Rows are told by the number, the sum and the difference of two hashes of their ids. At most
    the tokens of a URL, divided by the support, are so frequent.
    """
    tokens = rows.select("row", "blocked", F.explode("tokens").alias("token"))
    stood = tokens.groupBy("token").agg(
        F.count("*").alias("n"),
        F.count_if("blocked").alias("n_blocked"),
        F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("added"),
        F.bit_xor(F.xxhash64(F.lit("other"), "row")).alias("mixed"),
    )
    frequent = stood.where(F.col("n_blocked") >= least)
    same = frequent.groupBy("n", "added", "mixed").agg(
        F.min("token").alias("item"), F.collect_list("token").alias("tokens")
    )
    return saved(same.select("item", F.explode("tokens").alias("token")), "url-items")


def _with_tokens(rules: DataFrame, items: DataFrame) -> DataFrame:
    """Rules over items as rules over tokens, one of each item's."""
    numbered = saved(rules.withColumn("rule", F.monotonically_increasing_id()), "url-grown")
    choices = items.groupBy("item").agg(F.collect_list("token").alias("choices"))
    parts = numbered.select("rule", F.explode("antecedent").alias("item")).join(choices, "item")
    product = F.aggregate(
        F.collect_list("choices"),
        F.array(F.array().cast("array<string>")),
        lambda done, more: F.flatten(
            F.transform(done, lambda d: F.transform(more, lambda t: F.concat(d, F.array(t))))
        ),
    )
    chosen = parts.groupBy("rule").agg(product.alias("all")).select("rule", F.explode("all").alias("tokens"))
    return numbered.join(chosen, "rule").select(
        F.array_sort("tokens").alias("tokens"), "confidence", "lift", "support"
    )


def blocked_urls(urls: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    """The distinct URLs that fire a rule, with the strongest rule's confidence."""
    tokens = urls.select(F.col(url_col).alias("_url")).where("_url is not null").distinct()
    tokens = tokens.select("_url", url_tokens(F.col("_url")).alias("_has"))
    # The rarest token is taken from the rules' own statistics: fewer rules, rarer.
    uses = rules.select(F.explode("tokens").alias("_token"), "tokens").groupBy("_token").count()
    at = (
        rules.select(F.explode("tokens").alias("_token"), "tokens", "confidence")
        .join(uses, "_token")
        .groupBy("tokens", "confidence")
        .agg(F.min(F.struct("count", "_token")).alias("_rarest"))
        .select("tokens", "confidence", F.col("_rarest._token").alias("_token"))
    )
    met = tokens.select("_url", "_has", F.explode("_has").alias("_token")).join(at, "_token")
    fired = met.where(F.size(F.array_except("tokens", "_has")) == 0)
    return fired.groupBy("_url").agg(F.max("confidence").alias("_confidence"))


def explicit_rule(host: Column, path: Column, rules: list[HostRule], what: str) -> Column:
    """`what` ("name" or "verdict") of the longest rule that fits, else null.

    Of rules of the same length the one with the longer host wins.
    """
    if len(rules) > MAX_EXPLICIT_RULES:
        raise ValueError(f"more than {MAX_EXPLICIT_RULES} explicit rules")
    ordered = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.name))
    found = F.lit(None).cast("string")
    for rule in reversed(ordered):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, what))).otherwise(found)
    return found


def filter_urls(
    pages: DataFrame,
    mined: DataFrame,
    explicit: list[HostRule],
    url_col: str = "url",
) -> DataFrame:
    """`pages` with host, path, rule and verdict; columns of those names are replaced.

    A missing URL, or one without `://`, has an empty host and path, fits no rule and
    is allowed. Verdicts belong to URLs, so repeated rows get the same one; the join
    on the URL starts from shuffles that adaptive execution can split at a hot URL.
    """
    blocked = saved(blocked_urls(pages, mined, url_col), "url-blocked")
    taken = {"host", "path", "rule", "verdict"}
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in taken]
    # Names that no column of the pages has.
    at, sure = with_free_name(pages, "_url"), with_free_name(pages, "_confidence")
    blocked = blocked.withColumnsRenamed({"_url": at, "_confidence": sure})
    url = F.col(url_col)
    host, path = url_host(url), url_path(url)
    rule = explicit_rule(host, path, explicit, "name")
    ruled = explicit_rule(host, path, explicit, "verdict")
    method = F.when(F.col(sure).isNotNull(), "block").otherwise("allow")
    return pages.join(blocked, url == F.col(at), "left").select(
        *kept,
        host.alias("host"),
        path.alias("path"),
        rule.alias("rule"),
        F.coalesce(ruled, method).alias("verdict"),
    )
