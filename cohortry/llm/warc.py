"""Resolving "not modified" revisits of a web archive.

A revisit record holds the headers of a 304 answer but no body.  Its body is that
of the latest earlier full response (record type ``response``, status 200) to the
same canonical URL.  The answer's validators must agree with that response: the
entity tag if the revisit has one (weak comparison), else the modification time;
if they do not, the revisit stays open rather than taking an older body.  Header
fields of the answer replace the stored ones of the same name, except those that
describe the stored body or one connection.

The as-of join reads neither bodies nor headers but the validators.  Records are
range-partitioned by URL and time and written; each range finds its own earlier
responses with a window, and the last response of a URL is carried from range to
range over one row per range and URL.  So a URL with a third of all records is
spread over many tasks.  Headers are then joined by record, with the revisits of a
response that has very many of them spread over slices, each with its own copy of the
response; bodies stay where they are, named by the response's record_id, until
``with_payloads`` fetches them.

Records: ``record_id``, ``target_uri``, ``warc_date`` (any ordered type),
``record_type``, ``status``, ``http_headers`` (status line and fields, CRLF), and
``payload``.  Null or empty URLs, and null dates, resolve to nothing; a response
without payload or of another status is passed over; of responses at the same
time the one with the larger record_id is the later, and none is earlier than a
revisit of the same time; repeated responses count once, repeated revisits each;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.llm.stash import stash
from cohortry.plans.hot_keys import HotKeys

# Revisits of one response that meet it in one task.
SLICE_ROWS = 50_000
# Fields that a 304 answer does not change in a stored response.
KEPT_FIELDS = (
    "connection", "content-encoding", "content-length", "content-md5", "content-range",
    "content-type", "keep-alive", "proxy-authenticate", "proxy-authorization",
    "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)

_AUTHORITY = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?]*"


def canonical_url(uri: str) -> Column:
    """Scheme and host in lower case, no fragment and no default port, path at least /."""
    whole = F.regexp_replace(F.trim(F.col(uri)), r"#[\s\S]*$", "")
    authority = F.regexp_extract(whole, _AUTHORITY, 0)
    host = F.regexp_replace(F.lower(authority), r"^(http://.*):80$", "$1")
    host = F.regexp_replace(host, r"^(https://.*):443$", "$1")
    rest = F.substring(whole, F.length(authority) + 1, F.length(whole))
    path = F.when((rest == "") | rest.startswith("?"), F.concat(F.lit("/"), rest)).otherwise(rest)
    return F.when(whole != "", F.concat(host, path))


def header_fields(headers: str) -> str:
    """SQL for the (name, value) pairs of a header block, names in lower case."""
    lines = f"filter(split({headers}, '\\r?\\n'), (l, i) -> i > 0 AND instr(l, ':') > 1)"
    return (
        f"transform({lines}, l -> named_struct('name', lower(trim(substring_index(l, ':', 1))),"
        " 'value', trim(substring(l, instr(l, ':') + 1, length(l)))))"
    )


def _field(fields: str, name: str) -> str:
    """SQL for the first value of a field, NULL if there is none."""
    return f"get(filter({fields}, f -> f.name = '{name}'), 0).value"


def merged_fields(stored: str, fresh: str) -> str:
    """SQL for the stored fields with those of a 304 answer put in."""
    kept = ", ".join(f"'{name}'" for name in KEPT_FIELDS)
    allowed = f"filter({fresh}, f -> f.name NOT IN ({kept}))"
    names = f"transform({allowed}, f -> f.name)"
    return (
        f"sort_array(concat(filter({stored}, f -> NOT array_contains({names}, f.name)), {allowed}))"
    )


def as_of_responses(records: DataFrame) -> DataFrame:
    """The revisits of stored, slim records, each with the latest earlier response."""
    order = ["url", "warc_date", "is_full", "record_id"]
    ranged = (
        records.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_range", F.spark_partition_id())
    )
    ranged = stash(ranged, "warc-ranges")
    response = (
        "IF(is_full, named_struct('date', warc_date, 'id', record_id, 'etag', etag,"
        " 'modified', modified), NULL)"
    )
    marked = ranged.withColumn("_full", F.expr(response))
    within = marked.withColumn(
        "_own",
        F.expr(
            """last(_full, true) OVER (PARTITION BY _range, url ORDER BY warc_date, is_full, record_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
        ),
    ).where("is_revisit")
    # One row per range and URL; a URL has more than one only where it spans ranges.
    carried = (
        marked.groupBy("_range", "url")
        .agg(F.max("_full").alias("_last"))
        .selectExpr(
            "_range AS _r", "url AS _u",
            """last(_last, true) OVER (PARTITION BY url ORDER BY _range
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _carried""",
        )
        .where("_carried IS NOT NULL")
    )
    return within.join(carried, F.expr("_range = _r AND url = _u"), "left").selectExpr(
        "record_id", "url", "warc_date", "etag", "modified", "coalesce(_own, _carried) AS response"
    )


def _join_responses(
    resolved: DataFrame, responses: DataFrame, counted: DataFrame, slice_rows: int
) -> DataFrame:
    """Left join of usable revisits with the responses they refer to (``refers_to``).

    A response with more revisits than a slice is repeated for every slice, and its
    revisits are spread over them; ``counted`` has the revisits to count.
    """
    usable = "outcome IN ('resolved', 'unverified')"
    counts = counted.where(usable).groupBy("refers_to").agg(F.count(F.lit(1)).alias("_revisits"))
    hot = HotKeys(counts, "refers_to", "_revisits", slice_rows)
    left = hot.spread(resolved, "record_id").withColumnRenamed("_salt", "_slice")
    right = hot.repeat(responses).withColumnRenamed("refers_to", "_response")
    same = F.expr(f"{usable} AND refers_to = _response AND _slice = _salt")
    return left.join(right, same, "left").drop("_slice", "_salt")


def resolve_revisits(
    records: DataFrame, bodies: DataFrame | None = None, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """One row per revisit: outcome, response referred to, and merged headers.

    ``outcome`` is ``resolved``, ``unverified`` (no validators to check),
    ``mismatch`` or ``no_response``; only the first two have merged ``headers``.
    ``bodies`` may have one row per response, ``refers_to`` and further columns that
    usable revisits get as well.
    """
    kinds = records.select(
        "record_id",
        canonical_url("target_uri").alias("url"),
        "warc_date",
        F.expr("coalesce(record_type = 'revisit', false)").alias("is_revisit"),
        F.expr(
            "coalesce(record_type = 'response' AND status = 200 AND payload IS NOT NULL, false)"
        ).alias("is_full"),
        F.expr(header_fields("http_headers")).alias("fields"),
    ).where("is_revisit OR is_full")
    slim = kinds.selectExpr(
        "record_id", "url", "warc_date", "is_revisit", "is_full",
        f"regexp_replace({_field('fields', 'etag')}, '^W/', '') AS etag",
        f"{_field('fields', 'last-modified')} AS modified",
    )
    known = "url IS NOT NULL AND warc_date IS NOT NULL"
    lost = slim.where(f"is_revisit AND NOT ({known})").selectExpr(
        "record_id", "url", "warc_date", "etag", "modified"
    )
    found = as_of_responses(slim.where(known))
    outcome = """CASE WHEN response IS NULL THEN 'no_response'
        WHEN etag IS NOT NULL THEN IF(etag <=> response.etag, 'resolved', 'mismatch')
        WHEN modified IS NOT NULL THEN IF(modified <=> response.modified, 'resolved', 'mismatch')
        ELSE 'unverified' END"""
    judged = found.unionByName(lost, allowMissingColumns=True).selectExpr(
        "record_id", "url", "warc_date", f"{outcome} AS outcome",
        "response.id AS refers_to", "response.date AS refers_to_date",
    )
    judged = stash(judged, "warc-outcomes")
    # Repeated records hold the same headers; any one will do.
    texts = records.where("record_type IN ('response', 'revisit')").select("record_id", "http_headers")
    stored = texts.groupBy("record_id").agg(F.min("http_headers").alias("_stored"))
    fresh = texts.groupBy("record_id").agg(F.min("http_headers").alias("_fresh"))
    usable = F.expr("outcome IN ('resolved', 'unverified')")
    ids = judged.where(usable).select(F.col("refers_to").alias("record_id")).distinct()
    stored = stored.join(ids, "record_id", "left_semi").withColumnRenamed("record_id", "refers_to")
    more = []
    if bodies is not None:
        more = [c for c in bodies.columns if c != "refers_to"]
        stored = stored.join(bodies, "refers_to", "left")
    own = judged.join(fresh, "record_id", "left")
    return _join_responses(own, stored, judged, slice_rows).selectExpr(
        "record_id", "url", "warc_date", "outcome", "refers_to", "refers_to_date",
        f"""IF(_response IS NULL, NULL, array_join(transform(
            {merged_fields(header_fields('_stored'), header_fields('_fresh'))},
            f -> concat(f.name, ': ', f.value)), '\\n')) AS headers""",
        *more,
    )


def with_payloads(resolved: DataFrame, records: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Adds the body of the response that each usable revisit refers to."""
    bodies = (
        records.where("record_type = 'response' AND payload IS NOT NULL")
        .select(F.col("record_id").alias("refers_to"), "payload")
        .dropDuplicates(["refers_to"])
    )
    return _join_responses(resolved, bodies, resolved, slice_rows).drop("_response")


def captures(pages: DataFrame) -> DataFrame:
    """An archive derived from raw pages: a capture of each, and later visits.

    Besides the full response there are, for some pages, an error response and
    revisits with a weak tag, a wrong tag, a modification time, no validators, or
    a time before the response, under differently written URLs.
    """
    fields = """concat('HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nETag: "', substring(md5(html), 1, 12),
        '"\r\nLast-Modified: v', page_id % 7, '\r\nCache-Control: max-age=60\r\nContent-Length: ',
        length(html), '\r\nSet-Cookie: a=1\r\n\r\n')"""
    answer = "'HTTP/1.1 304 Not Modified\r\nCache-Control: max-age=600\r\nContent-Length: 0\r\nDate: d', 100 * page_id, '\r\n'"
    tag = "substring(md5(html), 1, 12)"
    variants = (
        ("true", 0, 0, "response", 200, "url", fields),
        ("page_id % 3 <> 0", 1, 40, "revisit", 304, "concat(url, '#seen')",
         f"""concat({answer}, 'ETag: W/"', {tag}, '"\r\n\r\n')"""),
        ("page_id % 5 = 0", 2, 60, "revisit", 304, "url", f"""concat({answer}, 'ETag: "other"\r\n\r\n')"""),
        ("page_id % 4 = 1", 3, 70, "revisit", 304,
         "regexp_replace(url, '^http://([^/?#]*)', 'HTTP://$1:80')",
         f"concat({answer}, 'Last-Modified: v', page_id % 7, '\r\n\r\n')"),
        ("page_id % 7 = 2", 4, -1, "revisit", 304, "url", f"""concat({answer}, 'ETag: "', {tag}, '"\r\n\r\n')"""),
        ("page_id % 6 = 5", 5, 80, "revisit", 304, "url", f"concat({answer}, '\r\n')"),
        ("page_id % 9 = 1", 6, 30, "response", 404, "url", "'HTTP/1.1 404 Not Found\r\n\r\n'"),
    )
    rows = ", ".join(
        f"""IF({when}, named_struct('record_id', 8 * page_id + {n}L, 'target_uri', {uri},
            'warc_date', 100 * page_id + {later}L, 'record_type', '{kind}', 'status', {status},
            'http_headers', {headers}, 'payload', IF('{kind}' = 'response', html, NULL)), NULL)"""
        for when, n, later, kind, status, uri, headers in variants
    )
    rows = rows.replace("\r\n", "\\r\\n")
    return pages.select("page_id", "url", "html").selectExpr(
        f"explode(filter(array({rows}), r -> r IS NOT NULL)) AS r"
    ).select("r.*")


def revisits(pages: DataFrame) -> DataFrame:
    """The resolved revisits of the derived archive, with a digest of their bodies.

    The digest is taken once per response, before the join, so that no body moves.
    """
    records = captures(pages)
    bodies = (
        records.where("record_type = 'response' AND status = 200 AND payload IS NOT NULL")
        .selectExpr(
            "record_id AS refers_to", "md5(payload) AS payload_md5", "CAST(length(payload) AS BIGINT) AS payload_chars"
        )
        .dropDuplicates(["refers_to"])
    )
    return resolve_revisits(records, bodies)


_FIELDS = """list_transform(list_filter(string_split(replace(http_headers, chr(13), ''), chr(10)),
    lambda l: strpos(l, ':') > 1), lambda l: {name: lower(trim(substr(l, 1, strpos(l, ':') - 1))),
    value: trim(substr(l, strpos(l, ':') + 1))})"""

_KEPT = ", ".join(f"'{name}'" for name in KEPT_FIELDS)

# The same rules over the same derived archive, as DuckDB SQL.
ORACLE = f"""
WITH base AS (
    SELECT page_id, url, html, substr(md5(html), 1, 12) AS tag,
        'HTTP/1.1 304 Not Modified' || chr(13) || chr(10) || 'Cache-Control: max-age=600' || chr(10)
        || 'Content-Length: 0' || chr(10) || 'Date: d' || (100 * page_id) || chr(10) AS answer
    FROM pages),
records AS (
    SELECT 8 * page_id AS record_id, url AS target_uri, 100 * page_id AS warc_date, 'response' AS kind,
        200 AS status, 'HTTP/1.1 200 OK' || chr(10) || 'Content-Type: text/html' || chr(10) || 'ETag: "' || tag
        || '"' || chr(10) || 'Last-Modified: v' || (page_id % 7) || chr(10) || 'Cache-Control: max-age=60'
        || chr(10) || 'Content-Length: ' || length(html) || chr(10) || 'Set-Cookie: a=1' AS http_headers,
        html AS payload FROM base
    UNION ALL SELECT 8 * page_id + 1, url || '#seen', 100 * page_id + 40, 'revisit', 304,
        answer || 'ETag: W/"' || tag || '"', NULL FROM base WHERE page_id % 3 <> 0
    UNION ALL SELECT 8 * page_id + 2, url, 100 * page_id + 60, 'revisit', 304,
        answer || 'ETag: "other"', NULL FROM base WHERE page_id % 5 = 0
    UNION ALL SELECT 8 * page_id + 3, regexp_replace(url, '^http://([^/?#]*)', 'HTTP://\\1:80'),
        100 * page_id + 70, 'revisit', 304, answer || 'Last-Modified: v' || (page_id % 7), NULL
        FROM base WHERE page_id % 4 = 1
    UNION ALL SELECT 8 * page_id + 4, url, 100 * page_id - 1, 'revisit', 304,
        answer || 'ETag: "' || tag || '"', NULL FROM base WHERE page_id % 7 = 2
    UNION ALL SELECT 8 * page_id + 5, url, 100 * page_id + 80, 'revisit', 304, answer, NULL
        FROM base WHERE page_id % 6 = 5
    UNION ALL SELECT 8 * page_id + 6, url, 100 * page_id + 30, 'response', 404,
        'HTTP/1.1 404 Not Found', html FROM base WHERE page_id % 9 = 1),
cut AS (
    SELECT *, regexp_replace(trim(target_uri), '#[\\s\\S]*$', '') AS whole,
        regexp_extract(regexp_replace(trim(target_uri), '#[\\s\\S]*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?]*') AS authority,
        {_FIELDS} AS fields FROM records),
named AS (
    SELECT *, regexp_replace(regexp_replace(lower(authority), '^(http://.*):80$', '\\1'),
            '^(https://.*):443$', '\\1')
        || CASE WHEN substr(whole, length(authority) + 1) = '' OR substr(whole, length(authority) + 1) LIKE '?%'
           THEN '/' ELSE '' END || substr(whole, length(authority) + 1) AS canonical,
        regexp_replace(list_filter(fields, lambda f: f.name = 'etag')[1].value, '^W/', '') AS etag,
        list_filter(fields, lambda f: f.name = 'last-modified')[1].value AS modified
    FROM cut),
full_responses AS (SELECT * FROM named WHERE kind = 'response' AND status = 200 AND payload IS NOT NULL),
ranked AS (
    SELECT v.record_id, v.canonical AS url, v.warc_date, v.etag, v.modified, v.fields,
        r.record_id AS rid, r.warc_date AS rdate, r.etag AS retag, r.modified AS rmodified,
        r.fields AS rfields, r.payload AS rpayload,
        row_number() OVER (PARTITION BY v.record_id ORDER BY r.warc_date DESC NULLS LAST, r.record_id DESC) AS n
    FROM named v LEFT JOIN full_responses r ON r.canonical = v.canonical AND r.warc_date < v.warc_date
    WHERE v.kind = 'revisit'),
judged AS (
    SELECT *, CASE WHEN rid IS NULL THEN 'no_response'
        WHEN etag IS NOT NULL THEN CASE WHEN etag = retag THEN 'resolved' ELSE 'mismatch' END
        WHEN modified IS NOT NULL THEN CASE WHEN modified = rmodified THEN 'resolved' ELSE 'mismatch' END
        ELSE 'unverified' END AS outcome,
        list_filter(fields, lambda f: f.name NOT IN ({_KEPT})) AS allowed
    FROM ranked WHERE n = 1)
SELECT record_id, url, warc_date, outcome, rid AS refers_to, rdate AS refers_to_date,
    CASE WHEN outcome IN ('resolved', 'unverified') THEN array_to_string(list_transform(list_sort(list_concat(
        list_filter(rfields, lambda f: NOT list_contains(list_transform(allowed, lambda a: a.name), f.name)),
        allowed)), lambda f: f.name || ': ' || f.value), chr(10)) END AS headers,
    CASE WHEN outcome IN ('resolved', 'unverified') THEN md5(rpayload) END AS payload_md5,
    CASE WHEN outcome IN ('resolved', 'unverified') THEN length(rpayload) END AS payload_chars
FROM judged
"""
