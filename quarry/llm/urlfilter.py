"""URL filters in DataFrame functions only: a blocked Bloom filter before an exact hash join.

A list holds rules (host, path, verdict) and single addresses.  A rule fits a
URL whose host is the rule's or a subdomain of it and whose path starts with
the rule's.  Every listed entry is one canonical string: ``host/path`` for a
rule, ``=`` and the canonical URL for an address.  A URL is looked up under all
strings that could be listed for it: its host's last labels and its path's
first characters in the shapes (number of labels, length) that occur in the
list, and its canonical form.

The strings first pass a blocked Bloom filter: blocks of 256 bits, eight bits a
string, all in one block, 16 bits of filter for each entry.  The filter is built by
a grouped ``bit_or`` and joined on the block's number.  Strings that pass are
possible hits; a hash join on the string itself removes the false ones.  Filter
and list are broadcast only if their measured size is at most ``BROADCAST_BYTES``;
beyond that both joins shuffle, and Spark splits what is skewed.  Lookups run
over distinct URLs, so a URL that a third of all rows share is looked up once.

Defined results: null URLs, and URLs without ``://``, have empty host and path;
no rule fits them and their verdict is the default.  The longest fitting rule
(characters of host and path together) decides, then the one with the longer
host, then ``block``.  Listed addresses count where no rule fits.  Rules with a
null or empty host, a null path or a null verdict, and null addresses, are ignored;
repeated ones count once.  Rows repeat as they come and keep all their columns in the struct
``page``.  A path is compared as it stands, letters of the host in lower case.
Very long URLs are looked up under the list's shapes only.  An empty table gives
no rows; an empty list gives every row the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialize, named
from quarry.llm.linededup import LOWER, UPPER

BLOCK_BITS, BITS_PER_KEY, WORDS = 256, 16, 4
BROADCAST_BYTES = 32 << 20
#: different (labels, path length) shapes that a list of rules may have
MAX_SHAPES = 4096
#: query parameters that do not change what a URL shows
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|\z)"


def rest_of(url: Column) -> Column:
    """What follows the first ``://``; empty where there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(rest_of(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(rest_of(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """One spelling for the URLs of a page: no scheme, ``www.``, usual port, fragment,
    ``.html``, closing slash or tracking parameter; the other parameters sorted."""
    host = F.regexp_replace(host_of(url), r"^www\.|:(80|443)\z", "")
    path = F.regexp_replace(path_of(url), r"(\.html|/)\z", "")
    query = F.regexp_extract(rest_of(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&", -1), lambda x: (x != "") & ~x.rlike(TRACKING))), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def _entries(rules: DataFrame, addresses: DataFrame) -> DataFrame:
    """(key, weight, verdict, rule, labels, length): one row for every listed string."""
    host = F.translate("host", UPPER, LOWER)
    good = "host <> '' AND path IS NOT NULL AND verdict IN ('allow', 'block')"
    own = rules.where(good).groupBy(host.alias("host"), "path").agg(F.max("verdict").alias("verdict"))
    own = own.select(
        F.concat("host", "path").alias("key"),
        F.struct(F.lit(1).alias("kind"), F.length(F.concat("host", "path")).alias("size"),
                 F.length("host").alias("host_size")).alias("weight"),
        "verdict", F.concat("host", "path").alias("rule"),
        F.size(F.split("host", r"\.", -1)).alias("labels"), F.length("path").alias("length"))
    one = addresses.where("url IS NOT NULL").select(canonical(F.col("url")).alias("c")).where("c <> ''").distinct()
    return own.unionByName(one.select(
        F.concat(F.lit("="), "c").alias("key"),
        F.struct(F.lit(0).alias("kind"), F.length("c").alias("size"), F.lit(0).alias("host_size")).alias("weight"),
        F.lit("block").alias("verdict"), F.lit(None).cast("string").alias("rule"),
        F.lit(None).cast("int").alias("labels"), F.lit(None).cast("int").alias("length")))


def _lookups(shapes: list[tuple[int, int]]) -> Column:
    """All strings under which the URL of a row could be listed."""
    host, path, n = F.col("host"), F.col("path"), F.size(F.split("host", r"\.", -1))
    rules = [F.when((host != "") & (n >= labels) & (F.length(path) >= length),
                    F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, length)))
             for labels, length in shapes]
    own = F.when(host != "", F.concat(F.lit("="), F.col("canonical")))
    return F.array_distinct(F.array_compact(F.array(own, *rules)))


def _masked(keys: DataFrame, blocks: int) -> DataFrame:
    """Adds each string's block and its bits in the block's words m0 .. m3."""
    h = F.xxhash64("key", F.lit(7))

    def bit(k: int) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"),
                               F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63).cast("long")).cast("int"))
    return keys.withColumns({"block": F.pmod(F.xxhash64("key"), F.lit(blocks).cast("long"))}
                            | {f"m{i}": bit(2 * i).bitwiseOR(bit(2 * i + 1)) for i in range(WORDS)})


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0 .. w3): the filter of the strings in ``key``, one row for each block in use."""
    return _masked(keys.select("key"), blocks).groupBy("block").agg(
        *[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS)])


def possible(keys: DataFrame, filter_: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``keys`` whose string passes the filter; none that is listed is lost."""
    if blocks * (BLOCK_BITS // 8 + 8) <= BROADCAST_BYTES:
        filter_ = F.broadcast(filter_)
    hit = F.lit(True)
    for i in range(WORDS):
        hit = hit & (F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
    return _masked(keys, blocks).join(filter_, "block").where(hit).select(*keys.columns)


def filter_urls(pages: DataFrame, rules: DataFrame, addresses: DataFrame, default: str = "allow") -> DataFrame:
    """(page, host, path, rule, verdict, listed) for every row of ``pages``.

    ``rules`` has (host, path, verdict), ``addresses`` has (url); pages at a listed
    address are blocked where no rule says otherwise.  ``listed`` tells whether the
    address is on the list.
    """
    entries = materialize(_entries(rules, addresses), "url-list")
    n, size = entries.agg(F.count("*"), F.sum(F.octet_length("key") + 64)).first()
    shapes = sorted(map(tuple, entries.where("labels IS NOT NULL").select("labels", "length").distinct()
                        .limit(MAX_SHAPES + 1).collect()))
    if len(shapes) > MAX_SHAPES:
        raise ValueError(f"the rules have more than {MAX_SHAPES} shapes (labels of the host, length of the path)")
    blocks = max(1, -(-n * BITS_PER_KEY // BLOCK_BITS))
    filter_ = bloom(entries, blocks)
    exact = entries.select("key", "weight", "verdict", "rule")
    exact = F.broadcast(exact) if (size or 0) <= BROADCAST_BYTES else exact.hint("shuffle_hash")

    url = F.col("url")
    urls = (pages.select(F.coalesce("url", F.lit("")).alias("url")).distinct()
            .select("url", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical"))
            .select("url", F.explode(_lookups(shapes)).alias("key")))
    found = (possible(urls, filter_, blocks).join(exact, "key").groupBy("url").agg(
        F.max(F.struct("weight", "verdict", "rule")).alias("best"), F.min("weight.kind").alias("least")))
    rows = pages.select(F.struct(*map(named, pages.columns)).alias("page"),
                        F.coalesce("url", F.lit("")).alias("url"))
    return rows.join(found, "url", "left").select(
        "page", host_of(url).alias("host"), path_of(url).alias("path"), F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.coalesce(F.col("least") == 0, F.lit(False)).alias("listed"))


SQL = r"""
WITH u AS (
  SELECT *, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, rest, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query,
         row_number() OVER () AS k FROM u
), c AS (
  SELECT *, regexp_replace(host, '^www\.|:(80|443)\z', '', 'g') || regexp_replace(path, '(\.html|/)\z', '')
            || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS canonical
  FROM (SELECT *, coalesce(array_to_string(list_sort(list_filter(string_split(query, '&'),
          lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|\z)'))), '&'), '') AS q FROM h)
), listed AS (
  SELECT canonical FROM c WHERE canonical <> '' GROUP BY canonical HAVING count(*) >= 2
), rules AS (
  SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                        ('net', '/es/', 'block'), ('net', '/fr/', 'block')) AS t(rhost, rpath, rverdict)
), best AS (
  SELECT k, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(rverdict, length(rhost || rpath)) AS rverdict
  FROM c JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY k
)
SELECT page_id, host, path, rule,
       coalesce(rverdict, CASE WHEN host <> '' AND listed.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       (host <> '' AND listed.canonical IS NOT NULL) AS listed
FROM c LEFT JOIN best USING (k) LEFT JOIN listed USING (canonical)
"""
