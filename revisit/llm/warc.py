"""Not-modified revisit records resolved to the full response they stand for.

A capture is a full response or a revisit. A revisit takes its body from the latest full response for the
same canonical URL that was captured before it, if a validator of both agrees: the entity tag (weakly
compared), else the payload digest, else the date of last modification. Headers that a not-modified answer
may renew replace the response's; all others are the response's own.

The as-of join is one pass per URL over captures in order of time. A URL's captures are cut into blocks of
days; within a block a window carries the latest response, and what a block inherits comes from a second
window over one row per block. So a URL with a third of all captures is many small tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Headers a not-modified answer may renew (fixed values of the HTTP caching rules).
RENEWED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]

BLOCK_SECONDS = 86_400


def canonical_url(url: Column) -> Column:
    """Scheme left out, host in lower case without www. and default port, no fragment, at least "/" as path,
    no slash at a longer path's end, query parameters sorted. Null and empty stay null."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    rest = F.regexp_replace(bare, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, "^([^/?]*)", 1)), "^www[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "(.)/+$", "$1")
    path = F.when(path == "", "/").otherwise(path)
    query = F.regexp_extract(rest, "[?](.*)$", 1)
    parameters = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: p != "")), "&")
    return F.when(rest != "", F.concat(host, path, F.when(parameters == "", "").otherwise(F.concat(F.lit("?"), parameters))))


def strong(tag: Column) -> Column:
    """An entity tag without its mark of weakness, as comparison for revisits is weak."""
    return F.regexp_replace(tag, "^W/", "")


def identity(record_id: Column, own: Column) -> Column:
    """A response as one text: ids may repeat, so its URL, time and validators are in it, too."""
    return F.to_json(F.struct(record_id.alias("id"), F.col("canonical_url").alias("url"), *[own[c].alias(c) for c in ("at", "digest", "etag", "modified")]))


def resolved(captures: DataFrame, renewed: list[str] = RENEWED, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """One row per revisit with what it resolves to.

    Captures have record_id, url, captured_at (timestamp), kind ('response' or 'revisit'), digest, body
    and headers (map of lower-case names). Returns record_id, canonical_url, captured_at, status, and of
    a resolved one refers_to, validator, body and the merged headers.

    status is 'resolved', 'validator_mismatch' (a response comes before, but the first validator that
    both have differs, or they have none in common) or 'no_earlier_response'. "Before" is an earlier time;
    at equal times responses come before revisits, and of several responses the largest record_id counts.
    Null times or URLs never resolve; other kinds are left out; null headers count as none. Repeated rows
    are captures of their own. Columns beyond the named ones play no part.
    """
    rows = captures.where(F.col("kind").isin("response", "revisit")).select(
        "record_id", canonical_url(F.col("url")).alias("canonical_url"), "captured_at", "kind", "digest", "body",
        F.coalesce("headers", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))).alias("headers"),
    )
    placed = rows.withColumn("at", F.unix_micros("captured_at"))
    # bodies stay behind: what is carried along is a response's id and validators
    carried = F.when(
        (F.col("kind") == "response") & F.col("captured_at").isNotNull() & F.col("canonical_url").isNotNull(),
        F.struct("record_id", "at", "digest", F.col("headers")["etag"].alias("etag"), F.col("headers")["last-modified"].alias("modified")),
    )
    narrow = placed.select(
        "record_id", "canonical_url", "at", "kind", "digest", "headers", carried.alias("own"),
        F.floor(F.col("at") / (block_seconds * 1_000_000)).alias("block"), (F.col("kind") == "revisit").cast("int").alias("later"),
    )
    order = ["at", "later", "record_id"]
    inside = W.partitionBy("canonical_url", "block").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    per_block = narrow.groupBy("canonical_url", "block").agg(F.max(F.when(F.col("own").isNotNull(), F.struct("at", "record_id", "own"))).alias("last"))
    before = W.partitionBy("canonical_url").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    inherited = per_block.select("canonical_url", "block", F.last("last", ignorenulls=True).over(before).alias("inherited"))
    found = (
        narrow.withColumn("latest", F.last("own", ignorenulls=True).over(inside))
        .where("kind = 'revisit'")
        .join(inherited, ["canonical_url", "block"], "left")
        .withColumn("latest", F.coalesce("latest", F.col("inherited.own")))
    )
    tag, modified = F.col("headers")["etag"], F.col("headers")["last-modified"]
    checks = [
        ("etag", strong(tag), strong(F.col("latest.etag"))),
        ("digest", F.col("digest"), F.col("latest.digest")),
        ("last-modified", modified, F.col("latest.modified")),
    ]
    verdict = F.lit(None).cast("struct<name:string,same:boolean>")
    for name, a, b in reversed(checks):
        verdict = F.when(a.isNotNull() & b.isNotNull(), F.struct(F.lit(name).alias("name"), (a == b).alias("same"))).otherwise(verdict)
    judged = found.withColumn("verdict", verdict).select(
        "record_id", "canonical_url", F.timestamp_micros("at").alias("captured_at"), "headers",
        F.when(F.col("latest").isNull(), "no_earlier_response").when(F.col("verdict.same"), "resolved").otherwise("validator_mismatch").alias("status"),
        F.when(F.col("verdict.same"), F.col("latest.record_id")).alias("refers_to"),
        F.when(F.col("verdict.same"), F.col("verdict.name")).alias("validator"),
        F.when(F.col("verdict.same"), identity(F.col("latest.record_id"), F.col("latest"))).alias("identity"),
    )
    # of responses alike in all of this, the smallest body counts
    own = F.struct("at", "digest", F.col("headers")["etag"].alias("etag"), F.col("headers")["last-modified"].alias("modified"))
    responses = placed.where("kind = 'response'").withColumn("own", own)
    responses = responses.groupBy(identity(F.col("record_id"), F.col("own")).alias("identity")).agg(F.min(F.struct("body", F.to_json("headers").alias("text"))).alias("full"))
    allowed = F.map_filter("headers", lambda name, _: name.isin(*renewed))
    original = F.from_json("full.text", "map<string,string>")
    kept = F.map_filter(original, lambda name, _: ~F.array_contains(F.map_keys(allowed), name))
    return judged.join(responses, "identity", "left").select(
        "record_id", "canonical_url", "captured_at", "status", "refers_to", "validator", F.col("full.body").alias("body"),
        F.when(F.col("status") == "resolved", F.map_concat(kept, allowed)).alias("headers"),
    )


def captures_from_pages(pages: DataFrame) -> DataFrame:
    """Captures derived from pages: each page's response, and up to two revisits of its URL.

    A revisit repeats the page's entity tag, or has an other one on every seventh page; every third page's
    first revisit has no tag but the payload's digest. The second one comes before the response. Pages are
    ten minutes apart, so that pages of one URL follow each other.
    """
    digest, at = F.md5(F.coalesce("html", F.lit("")).cast("binary")), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 600)
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 12), F.lit('"'))
    none = F.lit(None).cast("string")

    def headers(*pairs: tuple[str, Column]) -> Column:
        both = F.map_from_arrays(F.array(*[F.lit(k) for k, _ in pairs]), F.array(*[v for _, v in pairs]))
        return F.map_filter(both, lambda _, v: v.isNotNull())

    def day(column: Column) -> Column:
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")

    def record(kind: str, offset: int, seconds: int, body: Column, digest_: Column, head: Column) -> DataFrame:
        return pages.select(
            (F.col("page_id") * 4 + offset).alias("record_id"), "url", F.timestamp_seconds(F.unix_seconds(at) + seconds).alias("captured_at"),
            F.lit(kind).alias("kind"), digest_.alias("digest"), body.alias("body"), head.alias("headers"),
        )

    renewed_tag = F.when(F.col("page_id") % 7 == 0, F.lit('"other"')).when(F.col("page_id") % 3 == 0, none).otherwise(F.concat(F.lit("W/"), tag))
    return (
        record("response", 0, 0, F.col("html"), digest, headers(("etag", tag), ("date", day(at)), ("content-type", F.lit("text/html")), ("cache-control", F.lit("max-age=60"))))
        .unionByName(record("revisit", 1, 300, none, F.when(F.col("page_id") % 3 == 0, digest), headers(("etag", renewed_tag), ("date", day(F.timestamp_seconds(F.unix_seconds(at) + 300))), ("content-type", F.lit("text/plain")))))
        .unionByName(record("revisit", 2, -100, none, digest, headers(("date", day(F.timestamp_seconds(F.unix_seconds(at) - 100))), ("cache-control", F.lit("no-cache")))))
    )


#: The same in DuckDB's SQL, over `pages`; headers as columns.
SQL = r"""
WITH page AS (
  SELECT page_id, url, html, md5(coalesce(html, '')) AS digest, 1700000000 + page_id * 600 AS secs FROM pages
), canonical AS (
  SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM page
), parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^www[.]', ''), ':(80|443)$', '') AS host,
    regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '(.)/+$', '\1') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '[?](.*)$', 1), '&'), lambda x: x <> '')), '&') AS query FROM canonical
), named AS (
  SELECT *, CASE WHEN rest <> '' THEN host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN query = '' THEN '' ELSE '?' || query END END AS canonical_url,
    '"' || substr(digest, 1, 12) || '"' AS tag FROM parts
), response AS (
  SELECT page_id * 4 AS record_id, canonical_url, secs, tag, digest FROM named WHERE canonical_url IS NOT NULL
), revisit AS (
  SELECT page_id * 4 + 1 AS record_id, canonical_url, secs + 300 AS secs, CASE WHEN page_id % 3 = 0 THEN digest END AS digest,
    CASE WHEN page_id % 7 = 0 THEN '"other"' WHEN page_id % 3 = 0 THEN NULL ELSE tag END AS etag, CASE WHEN page_id % 7 = 0 THEN '"other"' WHEN page_id % 3 = 0 THEN NULL ELSE 'W/' || tag END AS shown,
    NULL AS control FROM named
  UNION ALL
  SELECT page_id * 4 + 2, canonical_url, secs - 100, digest, NULL, NULL, 'no-cache' FROM named
), joined AS (
  SELECT v.*, r.record_id AS found, r.tag AS r_tag, r.digest AS r_digest, r.secs AS r_secs
  FROM revisit v LEFT JOIN response r ON r.canonical_url = v.canonical_url AND r.secs <= v.secs
  QUALIFY row_number() OVER (PARTITION BY v.record_id ORDER BY r.secs DESC NULLS LAST, r.record_id DESC) = 1
), judged AS (
  SELECT *, CASE WHEN etag IS NOT NULL THEN 'etag' WHEN digest IS NOT NULL THEN 'digest' END AS by_what,
    CASE WHEN etag IS NOT NULL THEN etag = r_tag WHEN digest IS NOT NULL THEN digest = r_digest ELSE false END AS same FROM joined
)
SELECT record_id, canonical_url, CASE WHEN found IS NULL THEN 'no_earlier_response' WHEN same THEN 'resolved' ELSE 'validator_mismatch' END AS status,
  CASE WHEN found IS NOT NULL AND same THEN found END AS refers_to, CASE WHEN found IS NOT NULL AND same THEN by_what END AS validator,
  CASE WHEN found IS NOT NULL AND same THEN r_digest END AS body_md5,
  CASE WHEN found IS NOT NULL AND same THEN coalesce(shown, r_tag) END AS etag,
  CASE WHEN found IS NOT NULL AND same THEN 'text/html' END AS content_type,
  CASE WHEN found IS NOT NULL AND same THEN coalesce(control, 'max-age=60') END AS cache_control,
  CASE WHEN found IS NOT NULL AND same THEN strftime(make_timestamp(secs * 1000000), '%Y-%m-%d %H:%M:%S') END AS date
FROM judged
"""


def page_revisits(pages: DataFrame) -> DataFrame:
    """resolved() over the captures derived from pages, with a checksum for each body."""
    rows = resolved(captures_from_pages(pages))
    return rows.select(
        "record_id", "canonical_url", "status", "refers_to", "validator",
        F.when(F.col("status") == "resolved", F.md5(F.coalesce("body", F.lit("")).cast("binary"))).alias("body_md5"),
        *[F.col("headers")[name].alias(name.replace("-", "_")) for name in ("etag", "content-type", "cache-control", "date")],
    )
