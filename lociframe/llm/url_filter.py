"""URL filter by a cascade of Bloom filters, in DataFrame functions only.

Keys are strings `host suffix + path prefix`. Level 0 encodes the listed keys; level 1 those keys of the corpus's whole
key universe that level 0 passes though they are not listed; level 2 the listed keys that level 1 passes; and so on until
a level passes nothing false. A key of the universe is listed exactly if the number of levels it passes in a row is odd.
The filters are literal arrays of 64-bit words, so judging a url needs no join. Their size follows the number of listed
keys, a byte each up to MAX_KEYS; false positives shrink with every level.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.llm.frames import Scratch, table

#: Listed keys up to which filters are sent to every task: 2 MB.
MAX_KEYS = 2_000_000
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without one."""
    rest = F.substr(url, F.instr(url, "://") + 3)
    host = F.regexp_substr(rest, F.lit("^[^/?#]+"))
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) > 0, F.coalesce(lowered, F.lit(""))).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    rest = F.substr(url, F.instr(url, "://") + 3)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) > 0, path).otherwise("")


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """All keys that could fit: every suffix of the host's labels with every prefix of the path of a listed length, longest first."""
    labels = F.split(host, r"\.", -1)
    size = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), size), lambda i: F.array_join(F.slice(labels, i, size), "."))
    prefixes = F.filter(F.array(*(F.struct(F.lit(n).alias("n"), F.substring(path, 1, n).alias("p")) for n in lengths)), lambda x: F.length(x["p"]) == x["n"])
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda x: F.concat(s, x["p"]))))
    # longest key first; equal lengths (another split of host and path) in key order
    return F.transform(F.array_sort(F.transform(keys, lambda k: F.struct((-F.length(k)).alias("n"), k.alias("k")))), lambda x: x["k"])


@dataclass(frozen=True)
class Bloom:
    words: tuple[int, ...]  # 64 bits each
    seed: int
    hashes: int

    def passes(self, key: Column) -> Column:
        """True if every bit of the key is set. The words are one array literal, folded from its text before the query runs."""
        bits = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")
        total = 64 * len(self.words)
        test = F.lit(True)
        for i in range(self.hashes):
            at = F.pmod(F.xxhash64(F.lit(self.seed * 31 + i), key), F.lit(total))
            test = test & F.coalesce(F.getbit(F.get(bits, F.shiftright(at, 6).cast("int")), F.pmod(at, F.lit(64)).cast("int")) == 1, F.lit(False))
        return test


def build_bloom(keys: DataFrame, n: int, seed: int, bits_per_key: int = 8, hashes: int = 4) -> Bloom:
    """A Bloom filter of the strings in column `key`; its words (n * bits_per_key / 64 of them) are all that is collected."""
    size = max(1, -(-n * bits_per_key // 64))
    at = F.explode(F.array(*(F.pmod(F.xxhash64(F.lit(seed * 31 + i), F.col("key")), F.lit(64 * size)) for i in range(hashes))))
    words = keys.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(at, 64) AS int))")).alias("bits"))
    found = {r["word"]: r["bits"] for r in words.collect()}
    return Bloom(tuple(found.get(i, 0) for i in range(size)), seed, hashes)


def cascade(listed: DataFrame, universe: DataFrame, max_levels: int = 40) -> list[Bloom]:
    """Levels that together tell the listed keys from all others of the universe. Both frames have a column `key`.

    The universe is read once, for what level 0 passes; all further levels are made of that and of the listed keys. A filter
    takes a byte a key and is sent to every task: see MAX_KEYS.
    """
    scratch = Scratch(listed.sparkSession)
    known = scratch.written(listed.distinct(), "listed-keys")
    n = known.count()
    if n == 0:
        scratch.remove()
        return []
    levels = [build_bloom(known, n, 1)]
    passed = scratch.written(universe.where(levels[0].passes(F.col("key"))).distinct(), "passed-keys")
    left, right = passed.join(known, "key", "left_anti"), known
    while len(levels) < max_levels:
        n = left.count()
        if n == 0:
            scratch.remove()
            return levels
        levels.append(build_bloom(left, n, len(levels) + 1))
        left, right = right.where(levels[-1].passes(F.col("key"))), left
    raise ValueError(f"the cascade is not exact after {max_levels} levels")


def listed(levels: list[Bloom], key: Column) -> Column:
    """Exact membership for keys of the universe: the first level that a key does not pass decides."""
    answer = F.lit(len(levels) % 2 == 1)
    for i in range(len(levels) - 1, -1, -1):
        answer = F.when(levels[i].passes(key), answer).otherwise(F.lit(i % 2 == 1))
    return answer


def rule_frame(spark: SparkSession, rules: tuple[tuple[str, str, str], ...]) -> DataFrame:
    """Rows (key, length, verdict) of rules given as (host, path, verdict), from literals."""
    one = [F.struct(F.lit(h + p).alias("key"), F.lit(len(p)).alias("length"), F.lit(v).alias("verdict")) for h, p, v in rules]
    return spark.range(1).select(F.inline(F.array(*one)))


def url_filter(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] | DataFrame = RULES, id_col: str = "page_id", url_col: str = "url", default: str = "allow", max_keys: int = MAX_KEYS) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict), one per row of `pages`.

    rules: triples (host, path, verdict), or a frame with these columns for long lists. A rule fits its host and all
    subdomains where the path starts with the rule's; the longest fitting rule wins, and of equal ones the first verdict by
    name; without one the rule is null and the verdict `default`. A null url or one without `://` has empty host and path.
    Repeated rows keep a row each; no rules: every page has the default. Beyond `max_keys` rules the distinct (host, path)
    pairs are joined with them instead, with the same result.
    """
    spark = pages.sparkSession
    parts = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    if isinstance(rules, DataFrame):
        keyed = rules.select(F.concat("host", "path").alias("key"), F.length("path").alias("length"), "verdict").where("key is not null and verdict is not null")
    else:
        keyed = rule_frame(spark, rules) if rules else None
    shape = keyed.agg(F.count(F.lit(1)).alias("n"), F.collect_set("length").alias("lengths"), F.collect_set("verdict").alias("verdicts")).first() if keyed is not None else None
    if shape is None or not shape["n"]:
        return parts.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    lengths, verdicts = sorted(shape["lengths"]), sorted(shape["verdicts"])
    keys = candidate_keys(F.col("host"), F.col("path"), lengths)
    if shape["n"] > max_keys:
        return joined_rules(parts, keys, keyed, default)
    universe = parts.select(F.explode(keys).alias("key"))
    tests = [(v, cascade(keyed.where(F.col("verdict") == v).select("key"), universe)) for v in verdicts]

    def judged(key: Column) -> Column:
        out = F.lit(None).cast("string")
        for v, levels in reversed(tests):
            out = F.when(listed(levels, key), F.lit(v)).otherwise(out)
        return out

    fits = F.filter(F.transform(keys, lambda k: F.struct(k.alias("rule"), judged(k).alias("verdict"))), lambda x: x["verdict"].isNotNull())
    hit = F.get(fits, F.lit(0))
    return parts.select("page_id", "host", "path", hit.alias("hit")).select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))


def joined_rules(parts: DataFrame, keys: Column, keyed: DataFrame, default: str) -> DataFrame:
    """What `url_filter` gives, by joins on the keys: one row per distinct (host, path) and key that could fit."""
    rules = keyed.groupBy(F.col("key").alias("rule")).agg(F.min("verdict").alias("found"))
    tried = parts.select("host", "path").distinct().select("host", "path", F.explode(keys).alias("rule"))
    order = F.struct((-F.length("rule")).alias("n"), F.col("rule").alias("r"))
    best = tried.join(rules, "rule").groupBy(F.col("host").alias("h"), F.col("path").alias("p")).agg(F.min_by(F.struct("rule", "found"), order).alias("hit"))
    joined = parts.join(best, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
    return joined.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.found", F.lit(default)).alias("verdict"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))


OP9_SQL = r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), split AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]+'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parts
), rules(rhost, rpath, rverdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits AS (
  SELECT page_id, host, path, rhost || rpath AS rule, rverdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST) AS place
  FROM split LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM fits WHERE place = 1
"""
