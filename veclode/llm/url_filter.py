"""URL filters: a blocked Bloom filter in front of an exact hash join.

The list holds rules, which fit a host with its subdomains and a path prefix, and canonical
URLs, which fit themselves. A page asks for every key that could fit it: each suffix of its
host with each prefix of its path that is as long as some rule's path, and its canonical URL.
A register-blocked Bloom filter of the listed keys lets few of these through; the rest are
joined with the list itself, so no false positive stays. Only built-in expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veclode.llm.common import column, fresh_name, stored

# A block is four 64-bit words, with one bit of a key in each; 12 bits for each listed key.
WORDS = 4
BITS_PER_KEY = 12
# Filter blocks at most, 10 MB: a longer list makes the filter let more through, not fail.
MAX_BLOCKS = 1 << 18

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty for a null url or one without it."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    """Up to the first of ``/?#``, ASCII letters in lower case."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """From the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical_url(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, path without trailing slashes."""
    return F.concat(
        F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"/+$", "")
    )


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _mask(key: str, word: int) -> Column:
    """The bit of a key in one word of its block."""
    return F.expr(
        f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({key}, 17), {6 * word}) & 63 AS int))"
    )


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """The non-empty blocks of the filter of column ``key``: (block, w0, ..., w3)."""
    return keys.groupBy(_block(F.col("key"), blocks).alias("block")).agg(
        *[F.bit_or(_mask("key", w)).alias(f"w{w}") for w in range(WORDS)]
    )


def possible(asked: DataFrame, keys: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``asked`` whose ``key`` the filter of ``keys`` lets through."""
    hit = _block(F.col("key"), blocks) == F.col("block")
    for w in range(WORDS):
        hit &= F.col(f"w{w}").bitwiseAND(_mask("key", w)) != 0
    filter_ = F.broadcast(bloom_blocks(keys, blocks))  # MAX_BLOCKS rows at most
    return asked.join(filter_, hit, "left_semi")


def _listed(rules: DataFrame, listed: DataFrame | None) -> DataFrame:
    """All entries as (key, verdict, size, rule); rules under ``r:``, URLs under ``u:``.

    Of entries with the same key, one that blocks wins.
    """
    host = F.translate(F.col("host"), _UPPER, _LOWER)
    entries = rules.where("host IS NOT NULL").select(
        F.concat(F.lit("r:"), host, F.coalesce("path", F.lit(""))).alias("key"),
        "verdict",
    )
    if listed is not None:
        url = F.col("url")
        key = F.concat(F.lit("u:"), canonical_url(url_host(url), url_path(url)))
        urls = listed.where(F.locate("://", url) > 0)
        entries = entries.unionByName(urls.select(key.alias("key"), F.lit("block").alias("verdict")))
    return entries.groupBy("key").agg(F.max("verdict").alias("verdict"))


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    listed: DataFrame | None = None,
    url: str = "url",
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` for every row.

    ``rules`` has columns ``host``, ``path`` and ``verdict`` (allow or block); the longest
    rule that fits decides and is named, host and path together. Without one, a page whose
    canonical URL is that of a row of ``listed`` (column ``url``) is blocked and all others
    are allowed. A null url, or one without ``://``, has an empty host and path, fits nothing
    and is allowed. New columns whose names are taken get a trailing underscore.
    """
    entries = stored(_listed(rules, listed))
    sizes = rules.select(F.length(F.coalesce("path", F.lit(""))).alias("n")).distinct()
    lengths = sorted(r["n"] for r in sizes.collect())  # no more than a path has characters
    blocks = max(1, min(MAX_BLOCKS, -(-entries.count() * BITS_PER_KEY // (64 * WORDS))))

    names = [fresh_name(pages, n) for n in ("host", "path", "rule", "verdict")]
    own = column(pages, url)
    judged = pages.withColumns({names[0]: url_host(own), names[1]: url_path(own)})
    host, path, best_ = (fresh_name(judged, n) for n in ("asked_host", "asked_path", "best_"))
    places = judged.select(F.col(names[0]).alias(host), F.col(names[1]).alias(path)).distinct()

    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.transform(
        F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(path)),
        lambda n: F.substring(F.col(path), F.lit(1), n),
    )
    fitting = F.flatten(
        F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(F.lit("r:"), s, p)))
    )
    exact = F.concat(F.lit("u:"), canonical_url(F.col(host), F.col(path)))
    keys = F.concat(fitting, F.array(exact)) if lengths else F.array(exact)
    asked = places.where(F.col(host) != "").select(host, path, F.explode(keys).alias("key"))

    hits = possible(asked, entries, blocks).join(entries, "key")
    by_rule = F.col("key").startswith("r:")
    best = hits.groupBy(host, path).agg(
        F.max(
            F.struct(
                by_rule.alias("by_rule"),
                F.length("key").alias("size"),
                "verdict",
                F.when(by_rule, F.substring("key", 3, 1 << 30)).alias("rule"),
            )
        ).alias(best_)
    )
    same = (F.col(names[0]) == F.col(host)) & (F.col(names[1]) == F.col(path))
    said = {
        names[2]: F.col(best_)["rule"],
        names[3]: F.coalesce(F.col(best_)["verdict"], F.lit("allow")),
    }
    return judged.join(best, same, "left").withColumns(said).drop(host, path, best_)
