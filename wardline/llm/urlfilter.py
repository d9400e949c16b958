"""URL filter: ordered rules first, then exact list membership by a cascade of Bloom filters.

Building: the key universe is every key the corpus holds. Level 0 encodes the listed keys; the
unlisted keys it wrongly accepts are encoded by level 1; the listed keys that level 1 wrongly
accepts by level 2; and so on until a level accepts nothing wrongly. Looking a key of the universe
up walks the levels until one says no (or the levels end): at an even level that means unlisted, at
an odd one listed. So membership is exact for the whole universe, and needs no join.

Each level is built by Spark: keys hash to bit positions, positions fold into 64-bit words with
`bit_or`, and only the words come to the driver. Their size follows the listed keys. Keys are dealt by
hash into as many parts as keep a part's cascade within `max_filter_bytes`; every part has a cascade
of its own, one is sent at a time, and pages are judged by that of their host's part. Without listed
keys the cascade is empty and lists nothing.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick

BITS_PER_KEY = 10
HASHES = 4
MAX_FILTER_BYTES = 64 << 20


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: what follows the first :// up to / ? # or the end, A-Z lower-cased; path: from there
    up to ? # or the end. Null, or without ://: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def rule_match(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. `rules` is a short list of
    (verdict, rule) with rule = host/path; a rule fits its host and all subdomains where the path
    starts with the rule's path. Equally long rules: the first in the list."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The last `when` wins, so the longest rule is wrapped last.
    ranked = sorted(enumerate(rules), key=lambda r: (len(r[1][1]), -r[0]))
    for _, (what, text) in ranked:
        name, _, tail = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + tail)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


class Cascade:
    """Levels of (bits, words as 64-bit integers)."""

    def __init__(self, levels):
        self.levels = levels

    def lookup(self):
        """Function from two arrays of key hashes to an array of booleans: listed or not."""
        import numpy as np

        levels = [(bits, np.frombuffer(words, "<i8")) for bits, words in self.levels]

        def listed(first, second):
            first, second = np.asarray(first, "i8"), np.asarray(second, "i8")
            out = np.zeros(len(first), bool)
            open_keys = np.arange(len(first))
            for depth, (bits, words) in enumerate(levels):
                a, b = first[open_keys], second[open_keys]
                inside = np.ones(len(open_keys), bool)
                for j in range(HASHES):
                    spot = _spot(np, a, b, depth, j, bits)
                    inside &= (words[spot >> 6] >> (spot & 63)) & 1 == 1
                out[open_keys[~inside]] = depth % 2 == 1
                open_keys = open_keys[inside]
            # Passed every level: the last one accepts only what it encodes.
            out[open_keys] = len(levels) % 2 == 1
            return out

        return listed


def _spot(np, a, b, depth, j, bits):
    """Bit position of hash j; the same arithmetic as `_spots` (wrapping 64-bit integers)."""
    with np.errstate(over="ignore"):
        mixed = a * np.int64(2 * depth + 1) + b * np.int64(depth * HASHES + j + 1)
    return (mixed >> 17) % bits


def _spots(depth: int, bits: int) -> Column:
    """The bit positions as a column. Spark's products would raise on overflow, so the halves of a
    hash are multiplied apart and put together again modulo 2**64."""
    mask = F.lit(0xFFFFFFFF)

    def halves(x: Column, times: int) -> tuple[Column, Column]:
        return F.shiftright(x, 32) * times, x.bitwiseAND(mask) * times

    def one(j: int) -> Column:
        a_high, a_low = halves(F.col("a"), 2 * depth + 1)
        b_high, b_low = halves(F.col("b"), depth * HASHES + j + 1)
        low = a_low + b_low
        high = a_high + b_high + F.shiftright(low, 32)
        whole = F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(mask))
        return F.pmod(F.shiftright(whole, 17), F.lit(bits).cast("bigint"))

    return F.array(*[one(j) for j in range(HASHES)])


def key_hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(key, F.lit("second"))


def build_cascade(universe: DataFrame, materialize=None) -> Cascade:
    """Cascade over (key, listed boolean), one row per key. `materialize` writes a frame that
    several passes read (a function of frame and name)."""
    a, b = key_hashes(F.col("key"))
    keys = universe.where(F.col("key").isNotNull()).select("listed", a.alias("a"), b.alias("b"))
    if materialize:
        keys = materialize(keys, "cascade-keys")
    levels, inside = [], None
    while True:
        depth = len(levels)
        wanted = keys if inside is None else keys.where(inside)
        encoded = wanted.where("listed" if depth % 2 == 0 else "NOT listed")
        n = encoded.count()
        if n == 0:
            return Cascade(levels)
        bits = 64 * max(1, math.ceil(n * BITS_PER_KEY / 64))
        levels.append((bits, _words(encoded, depth, bits)))
        passes = _passes(levels[-1], depth)
        inside = passes if inside is None else inside & passes


def _words(encoded: DataFrame, depth: int, bits: int) -> bytes:
    """The filter's words: at most bits / 64 rows come to the driver."""
    import numpy as np

    spot = encoded.select(F.explode(_spots(depth, bits)).alias("spot"))
    rows = (
        spot.groupBy(F.shiftright("spot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 AS int))")).alias("value"))
        .toPandas()
    )
    words = np.zeros(bits // 64, "<i8")
    words[rows["word"].to_numpy(dtype="i8")] = rows["value"].to_numpy(dtype="i8")
    return words.tobytes()


def _passes(level, depth: int) -> Column:
    bits, raw = level

    @F.pandas_udf("boolean")
    def accepted(a: pd.Series, b: pd.Series) -> pd.Series:
        import numpy as np

        words = np.frombuffer(raw, "<i8")
        inside = np.ones(len(a), bool)
        for j in range(HASHES):
            spot = _spot(np, a.to_numpy("i8"), b.to_numpy("i8"), depth, j, bits)
            inside &= (words[spot >> 6] >> (spot & 63)) & 1 == 1
        return pd.Series(inside, index=a.index)

    return accepted("a", "b")


def cascade_parts(universe: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES) -> int:
    """Parts to deal the keys into: a cascade takes some twice its first level."""
    listed = universe.where("listed").count()
    return max(1, -(-2 * listed * BITS_PER_KEY // (8 * max_filter_bytes)))


def with_listed(frame: DataFrame, key: str, cascade: Cascade) -> DataFrame:
    """The frame with a boolean column `listed`, by the cascade."""
    held = frame.sparkSession.sparkContext.broadcast(cascade)  # bounded by `cascade_parts`

    @F.pandas_udf("boolean")
    def member(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(held.value.lookup()(a.to_numpy("i8"), b.to_numpy("i8")), index=a.index)

    a, b = key_hashes(F.col(key))
    return frame.withColumn("listed", F.coalesce(F.when(F.col(key).isNotNull(), member(a, b)), F.lit(False)))


def judge(pages: DataFrame, rules, listed_hosts, materialize, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for pages (page_id, url).

    `listed_hosts` is a function from a DataFrame (host), one row per host of the pages, to a
    boolean column that says which of them are listed: the block list over the complete universe.
    A page without a fitting rule is blocked if its host is listed and allowed otherwise."""
    plain = pick(pages, "page_id", "url")
    host, path = host_and_path(F.col("url"))
    parsed = plain.select("page_id", host.alias("host"), path.alias("path"))
    hosts = parsed.select("host").distinct()
    universe = hosts.select(F.col("host").alias("key"), listed_hosts(F.col("host")).alias("listed"))
    universe = materialize(universe, "url-universe")
    parts = cascade_parts(universe, max_filter_bytes)
    if parts == 1:
        marked = with_listed(parsed, "host", build_cascade(universe, materialize))
    else:
        marked = None
        for part in range(parts):
            own = [f.where(F.pmod(F.xxhash64(c, F.lit("part")), F.lit(parts)) == part) for f, c in ((universe, "key"), (parsed, "host"))]
            # Written at once, so that one cascade is sent at a time.
            some = materialize(with_listed(own[1], "host", build_cascade(own[0], materialize)), "url-part")
            marked = some if marked is None else marked.unionByName(some)
    rule, verdict = rule_match(F.col("host"), F.col("path"), rules)
    by_list = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return marked.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_list).alias("verdict"))
