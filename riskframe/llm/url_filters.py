"""URL verdicts: host and path rules, then a list of canonical URLs behind a blocked Bloom filter.

Native: DataFrame functions only.  The filter is an aggregate (one 64-bit word per block), so it is
built with map-side combining; pages look their word up by block number, and only pages that pass
reach the exact join with the list.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and is
on no list; repeated pages are judged one by one; repeated or null list entries count once or not
at all; an empty list blocks nothing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.text import lower_ascii

#: A filter of up to this many bytes is broadcast; a larger one is joined by block number.
BROADCAST_BYTES = 32 << 20
BITS_PER_URL = 16
HASHES = 4


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling per address: no scheme, ``www.`` or ``m.``, tracking parameters, fragment or closing slash.

    Null where the URL has no host.
    """
    query = F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1)
    kept = F.regexp_replace(query, "(^|&)(utm_[^=&]*|ref)(=[^&]*)?(?=&|$)", "")
    kept = F.regexp_replace(kept, "^&+", "")
    plain = F.concat(
        F.regexp_replace(host(url), r"^(www|m)\.", ""),
        F.regexp_replace(path(url), "/+$", ""),
        F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""),
    )
    return F.when(host(url) != "", plain)


def matching_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits; both null if none does.

    ``rules`` is a setting of a few entries, so it becomes one expression per row.
    """
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _blocks(n_urls: int) -> int:
    return 1 << max(0, math.ceil(math.log2(max(1, n_urls) * BITS_PER_URL / 64)))


def _block(url: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(n_blocks)).alias("block")


def _mask(url: Column) -> Column:
    """The bits of a URL inside its block's word."""
    bits = F.xxhash64(url, F.lit("bits"))
    mask = F.lit(0).cast("long")
    for i in range(HASHES):
        place = F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask.alias("mask")


def bloom_filter(listed: DataFrame, n_urls: int) -> DataFrame:
    """(block, word) of the distinct URLs in ``listed.listed_url``."""
    n_blocks = _blocks(n_urls)
    masks = listed.select(_block(F.col("listed_url"), n_blocks), _mask(F.col("listed_url")))
    return masks.groupBy("block").agg(F.bit_or("mask").alias("word"))


def listed_urls(listed: DataFrame, url: str) -> DataFrame:
    """Distinct canonical URLs, one column ``listed_url``."""
    return listed.select(canonical(F.col(url)).alias("listed_url")).where("listed_url IS NOT NULL").distinct()


def linked(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url) of every link on ``pages`` with a host of its own, or from the root of its page's host.

    Links relative to a page, anchors and other schemes name no address and are left out.
    """
    links = pages.select(host(F.col(url)).alias("from"), F.explode(F.regexp_extract_all(F.col(html), F.lit('href="([^"]*)"'), F.lit(1))).alias("link"))
    link = F.col("link")
    whole = (
        F.when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.startswith("/"), F.concat(F.lit("http://"), "from", link))
        .when(link.contains("://"), link)
    )
    return links.select(whole.alias("url")).where("url IS NOT NULL")


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict) of every page; ``listed`` comes from :func:`listed_urls`.

    The rule's verdict stands; otherwise a page on the list is blocked and any other allowed.
    """
    n_urls = listed.count()
    n_blocks = _blocks(n_urls)
    words = bloom_filter(listed, n_urls)
    if 16 * n_blocks <= BROADCAST_BYTES:
        words = F.broadcast(words)
    rule, ruled = matching_rule(rules, F.col("host"), F.col("path"))
    address = F.col("address")
    parsed = (
        pages.select(F.col(key), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"), canonical(F.col(url)).alias("address"))
        .withColumns({"rule": rule, "ruled": ruled, "block": _block(address, n_blocks), "mask": _mask(address)})
        .join(words, "block", "left")
        .withColumn("possible", F.coalesce(F.col("word").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False)) & address.isNotNull())
    )
    out = [F.col(key), F.col("host"), F.col("path"), F.col("rule")]
    rest = parsed.where("NOT possible").select(*out, F.coalesce("ruled", F.lit("allow")).alias("verdict"))
    passed = parsed.where("possible").join(listed, F.col("address") == F.col("listed_url"), "left")
    hit = F.when(F.col("listed_url").isNotNull(), "block").otherwise("allow")
    return rest.unionByName(passed.select(*out, F.coalesce("ruled", hit).alias("verdict")))
