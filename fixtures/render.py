"""Dump lines made from the test tables.

The test data holds no dump, so its tables are rendered as one: one `<row .../>`
line per table row, between envelope lines. Every row and every text of the
tables used is rendered, whole and without a join; rendering is a projection of the scan.
Attributes are left out, empty or filled by rules on the row's own values.

`fixtures/oracle.py` computes the expected results from the same tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qadump.schemas import (
    BADGES,
    COMMENTS,
    POST_HISTORY,
    POST_LINKS,
    POSTS,
    USERS,
    XML_DECLARATION,
    Entity,
)

# What a dump writer puts in place of characters.
ESCAPES = (
    ("&", "&amp;"),
    ("<", "&lt;"),
    (">", "&gt;"),
    ('"', "&quot;"),
    ("\r", "&#xD;"),
    ("\n", "&#xA;"),
    ("\t", "&#x9;"),
)


def escaped(text: str) -> str:
    for raw, entity in ESCAPES:
        text = f"replace({text}, '{raw}', '{entity}')"
    return text


def row_line(numbers: dict[str, str], texts: dict[str, str]) -> str:
    """SQL text of a record line; an attribute whose expression is null is left out."""
    values = numbers | {name: escaped(expression) for name, expression in texts.items()}
    parts = [
        f"coalesce(concat(' {name}=\"', {value}, '\"'), '')" for name, value in values.items()
    ]
    return f"concat('  <row', {', '.join(parts)}, ' />')"


def _lines(table: DataFrame, numbers: dict[str, str], texts: dict[str, str]) -> DataFrame:
    # a generator, so that filters on the line stay above it and it is built once
    return table.selectExpr(f"explode(array({row_line(numbers, texts)})) as value")


def _with_envelope(entity: Entity, *bodies: DataFrame) -> DataFrame:
    spark = bodies[0].sparkSession

    def constant(*values: str) -> DataFrame:
        one_row = spark.range(0, 1, 1, 1)
        return one_row.selectExpr(f"explode(array({', '.join(map(repr, values))})) as value")

    parts = (
        constant(XML_DECLARATION, f"<{entity.name}>"),
        *bodies,
        constant(f"</{entity.name}>"),
    )
    return reduce(DataFrame.union, parts)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Fixed value: users whose key leaves 3 by 10, and the posts of orders 7 by 10, have ids
# beyond 32 bits.
FAR = 3_000_000_000
USER_ID = f"case when key % 500 <> 499 then key + if(key % 10 = 3, {FAR}, 0) end"
POST_ID = f"(o_orderkey * 4 + if(o_orderkey % 10 = 7, {FAR}, 0))"

_SIGNUP = "timestamp_ntz'2008-07-31 21:42:52.667' + make_dt_interval(0, 0, 0, c_custkey)"
# every 20th user was last seen after 2038
_LAST_ACCESS = f"{_SIGNUP} + make_dt_interval(c_nationkey + if(c_custkey % 20 = 4, 12000, 0))"


def _iso(moment: str) -> str:
    # a cast, because date_format would go through the session zone
    return f"replace(cast({moment} as string), ' ', 'T')"


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _lines(
        _table(spark, sf_dir, "customer"),
        {
            "Id": USER_ID.replace("key", "c_custkey"),
            "Reputation": "floor(c_acctbal)",
            "CreationDate": _iso(_SIGNUP),
            "LastAccessDate": f"case when c_custkey % 10 <> 9 then {_iso(_LAST_ACCESS)} end",
            "Views": "c_custkey * 3",
            "UpVotes": "c_custkey % 50",
            "DownVotes": "case c_custkey % 50 when 8 then '9999999999' when 9 then 'x' "
            "else string(c_custkey % 7) end",
            "Age": "case c_custkey % 4 when 0 then null when 1 then '' "
            "else string(18 + c_custkey % 60) end",
        },
        {
            "DisplayName": "c_name",
            "WebsiteUrl": "case c_nationkey % 3 when 0 then 'http://example.org/?a=1&b=2' "
            "when 1 then '' end",
            "Location": "case when c_mktsegment = 'BUILDING' then c_mktsegment end",
            "AboutMe": "case when c_custkey % 2 = 0 then concat('<p>', c_name, '</p>\\n') end",
        },
    )
    return _with_envelope(USERS, customers)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts from four tables; ids differ by their remainder by 4."""
    orders = _lines(
        _table(spark, sf_dir, "orders"),
        {
            "Id": POST_ID,
            "PostTypeId": "case o_orderstatus when 'F' then 1 when 'O' then 2 else 4 end",
            "AcceptedAnswerId": "case when o_orderstatus = 'F' and o_orderkey % 3 = 0 "
            "then o_orderkey * 4 + 4 end",
            "Score": "floor(o_totalprice / 1000) - 100",
            "ViewCount": "case when o_orderstatus = 'F' then floor(o_totalprice) end",
            "OwnerUserId": "case o_orderkey % 20 when 0 then null when 1 then '' "
            f"else string(o_custkey + if(o_custkey % 10 = 3, {FAR}, 0)) end",
            "AnswerCount": "case when o_orderstatus = 'F' then o_orderkey % 5 end",
            "CommentCount": "o_orderkey % 4",
            "FavoriteCount": "case when o_orderkey % 6 = 0 then o_orderkey % 11 end",
        },
        {"Body": "concat('<p>', o_orderpriority, '</p>\\n')"},
    )
    documents = _lines(
        _table(spark, sf_dir, "documents"),
        {
            "Id": "doc_id * 4 + 1",
            "PostTypeId": "if(lang = 'en', 1, 2)",
            "Score": "n_chars % 100 - 50",
            "OwnerUserId": "doc_id div 7",
            "CommentCount": "case when doc_id % 3 = 0 then doc_id % 13 end",
        },
        {"Body": "text"},
    )
    pages = _lines(
        _table(spark, sf_dir, "pages"),
        {
            "Id": "page_id * 4 + 2",
            "PostTypeId": "if(page_id % 2 = 0, 1, 2)",
            "Score": "page_id % 17",
            "ViewCount": "length(html)",
            "AnswerCount": "if(page_id % 2 = 0, 1, null)",
        },
        {"Body": "html", "Title": "url"},
    )
    turns = _lines(
        _table(spark, sf_dir, "conversations"),
        {
            "Id": "(conv_id * 100 + turn) * 4 + 3",
            "PostTypeId": "case role when 'user' then 1 when 'assistant' then 2 else 5 end",
            "AcceptedAnswerId": "case when role = 'user' then (conv_id * 100 + turn + 1) * 4 + 3 end",
            "Score": "turn",
            "OwnerUserId": "conv_id",
            "AnswerCount": "case when role = 'user' then 1 end",
        },
        {"Body": "text"},
    )
    return _with_envelope(POSTS, orders, documents, pages, turns)


def _event_lines(spark: SparkSession, sf_dir: str, badges: bool) -> DataFrame:
    # purchases, signups and errors become badges, clicks and views comments
    events = _table(spark, sf_dir, "events")
    is_comment = F.col("event_type").isin("click", "view")
    numbers = {
        "Id": "event_id",
        "UserId": "case event_id % 25 when 0 then null when 1 then '' "
        f"else string(user_id + if(user_id % 10 = 3, {FAR}, 0)) end",
    }
    if badges:
        return _lines(events.where(~is_comment), numbers, {"Name": "event_type"})
    return _lines(events.where(is_comment), numbers, {"Text": "props"})


def badges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_envelope(BADGES, _event_lines(spark, sf_dir, badges=True))


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_envelope(COMMENTS, _event_lines(spark, sf_dir, badges=False))


def post_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = _lines(
        _table(spark, sf_dir, "lineitem"),
        {
            "Id": "l_orderkey * 10 + l_linenumber",
            "PostId": f"l_orderkey + if(l_orderkey % 10 = 7, {FAR}, 0)",
            "RelatedPostId": "l_partkey",
        },
        {},
    )
    return _with_envelope(POST_LINKS, links)


def post_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    edits = _lines(
        _table(spark, sf_dir, "lineitem"),
        {
            "Id": "l_orderkey * 10 + l_linenumber",
            "PostHistoryTypeId": "l_linenumber",
            "PostId": f"l_orderkey + if(l_orderkey % 10 = 7, {FAR}, 0)",
            "UserId": f"case when l_partkey % 30 <> 0 then l_suppkey + if(l_suppkey % 10 = 3, {FAR}, 0) end",
        },
        {"Comment": "concat(l_returnflag, ' & ', l_linestatus)"},
    )
    return _with_envelope(POST_HISTORY, edits)


LINES = {
    USERS: users,
    POSTS: posts,
    BADGES: badges,
    COMMENTS: comments,
    POST_LINKS: post_links,
    POST_HISTORY: post_history,
}


# A dump with faults: besides all good lines, every order and every customer adds
# one faulty line, of a kind that follows from its own columns.
FAULTY_POST = """case
    when o_orderpriority = '1-URGENT' then format_string('  <row Id="%d" Body="no type" />', o_orderkey)
    when o_orderpriority = '2-HIGH' then format_string('  <row Id="%d" Score=3 />', o_orderkey)
    when o_orderpriority = '3-MEDIUM' and o_orderstatus = 'P' then ''
    when o_orderpriority = '3-MEDIUM' and o_orderstatus = 'O' then format_string(
        '  <row Id="%d99999999999999999999" PostTypeId="1" />', o_orderkey)
    when o_orderpriority = '3-MEDIUM' then format_string('  <tag Id="%d" />', o_orderkey)
    when o_orderpriority = '4-NOT SPECIFIED' then format_string(
        '  <row Id="%d" PostTypeId="1" /><row Id="5" PostTypeId="2" />', o_orderkey)
    when o_orderstatus = 'F' then format_string(
        '  <row Id="%d" x:y="5" PostTypeId="1" />', o_orderkey)
    when o_orderstatus = 'O' then format_string(
        '  <row Id="%d" PostTypeId="1" Body="a&nbsp;b" />', o_orderkey)
    else format_string('  <row Id="%d" Id="5" PostTypeId="1" />', o_orderkey)
end"""
FAULTY_USER = """case c_mktsegment
    when 'BUILDING' then format_string('  <row Id="%d" CreationDate="31 July 2008" />', c_custkey)
    when 'MACHINERY' then format_string('  <row Id="%d" LastAccessDate="" />', c_custkey)
    else format_string('  <row Id="%d" CreationDate="2008-02-30T00:00:00.000" />', c_custkey)
end"""


def _faulty_lines(table: DataFrame, line: str) -> DataFrame:
    return table.selectExpr(f"explode(array({line})) as value")


def faulty_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    faults = _faulty_lines(_table(spark, sf_dir, "customer"), FAULTY_USER)
    return users(spark, sf_dir).union(faults)


def faulty_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    faults = _faulty_lines(_table(spark, sf_dir, "orders"), FAULTY_POST)
    return posts(spark, sf_dir).union(faults)


FAULTY_LINES = LINES | {USERS: faulty_users, POSTS: faulty_posts}


def write_dump(
    spark: SparkSession, sf_dir: str, target: str, entities=tuple(LINES)
) -> dict[Entity, str]:
    """Write rendered dump files (folders of text) below `target`; return their paths."""
    paths = {}
    for entity in entities:
        paths[entity] = f"{target}/{entity.file}"
        LINES[entity](spark, sf_dir).write.text(paths[entity])
    return paths
