"""Input relations derived from the test tables.

Each text runs unchanged on Spark and DuckDB; ``{name}`` stands for a base table or
another view. Nothing here filters or samples: a view covers its whole table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("pages", "events", "labels", "documents", "conversations", "lineitem", "orders")

_S = "cast({} as string)".format


def _reply_case(n: str, k: str) -> str:
    """Reply texts of every shape, chosen by ``n``."""
    shapes = [
        f"""'{{{{"mood":"festive","caption":"j'||{_S(k)}||'","score":1.5,"indoors":"false","objects":["a","b"],"spot":{{{{"country":"x","city":null}}}},"lang":null,"extra":1}}}}'""",
        f"""'{{{{"mood":"Lively","caption":null,"score":'||{_S(k)}||',"indoors":0}}}}'""",
        """'{{"mood":"bogus","indoors":[],"objects":[],"spot":"nowhere","score":"many"}}'""",
        """'{{"mood":null,"indoors":true,"lang":"en"}}'""",
        "''",
        "'[1]'",
        "'oops'",
        "cast(null as string)",
        """' {{"mood":"GRIM","indoors":{{}},"score":"7"}}'""",
        """'{{"mood":"calm"}} and more'""",
        "'\"text\"'",
        """'{{"indoors":"","mood":"CALM"}}'""",
        f"""'{{{{"indoors":0.0,"spot":{{{{"city":"c'||{_S(k)}||'"}}}},"mood":"grim"}}}}'""",
        "'{{}}'",
        """'{{"caption":12,"indoors":"0","objects":["x"],"mood":"Festive"}}'""",
        "'null'",
    ]
    whens = " ".join(f"when {i} then {s}" for i, s in enumerate(shapes))
    return f"case {n} % {len(shapes)} {whens} end"


_ERROR_CASE = """case {n} % 6
      when 0 then '429 RESOURCE_EXHAUSTED. Please retry in '||cast({k} % 90 as string)||'.5s'
      when 1 then '429 quota exceeded: GenerateRequestsPerDay retry in 14h30m13.78s'
      when 2 then '500 INTERNAL'
      when 3 then '403 permission denied'
      when 4 then 'Rate limit per day quota'
      else '429 too many requests' end"""

VIEWS: dict[str, str] = {}

# Nulls, blanks, /statuses/, NaN, URLs without a scheme, duplicates.
VIEWS["posts"] = """select page_id as ordinal,
  case page_id % 10
    when 0 then null
    when 1 then ' https://x.com/u'||cast(page_id % 7 as string)||'/statuses/'||cast(page_id % 40 as string)||' '
    when 2 then 'https://x.com/u'||cast(page_id % 7 as string)||'/status/'||cast((page_id-1) % 40 as string)
    when 3 then 'NaN'
    when 4 then 'https://www.instagram.com/p/'||cast(page_id % 30 as string)
    when 5 then 'fb.watch/'||cast(page_id as string)
    else url end as post_url,
  case page_id % 4
    when 0 then null
    when 1 then 'https://cdn.example.com/m'||cast(page_id as string)||'.MP4'
    when 2 then 'https://cdn.example.com/m'||cast(page_id as string)||'.webp'
    else 'https://cdn.example.com/m'||cast(page_id as string) end as media_url,
  case page_id % 6 when 0 then 'x' when 1 then 'instagram' when 2 then 'facebook'
    when 3 then 'youtube' when 4 then 'tiktok' else null end as platform
from {pages}"""

# A larger queue, with one URL on a third of its rows.
VIEWS["bulk_posts"] = """select l_orderkey * 8 + l_linenumber as ordinal,
  case when l_linenumber % 3 = 0 then 'https://x.com/hot/statuses/1'
    else 'https://cdn.example.com/p'||cast(l_partkey as string)||'/'||cast(l_suppkey as string) end as post_url,
  'https://cdn.example.com/m'||cast(l_partkey as string)||'.jpg' as media_url,
  l_returnflag as platform,
  cast(l_quantity as bigint) as likes
from {lineitem}"""

# Three attempts per key, every decision present.
VIEWS["attempts"] = f"""select cast(floor(event_id/3.0) as bigint) as k,
  cast(event_id % 3 as int) as attempt,
  case when event_type in ('error','click','view') then
    {_ERROR_CASE.format(n='(event_id * 7 + user_id)', k='event_id')} end as err,
  case when event_type = 'signup' then props
    when event_type = 'purchase' then
      case event_id % 4 when 0 then '' when 1 then '[1]' when 2 then 'oops' else props end
    end as resp
from {{events}}"""

# Six attempts per key: three on the primary model, three on the fallback.
VIEWS["calls"] = f"""select cast(floor(event_id/6.0) as bigint) as k, 1 as pass,
  case when event_id % 6 < 3 then 'primary' else 'fallback' end as model,
  cast(event_id % 3 as int) as attempt,
  case when event_type in ('error','click') then
    {_ERROR_CASE.format(n='(event_id * 7 + user_id)', k='event_id')} end as err,
  case when event_type in ('signup','purchase','view') then
    {_reply_case('(event_id + user_id)', '(event_id % 90)')} end as resp
from {{events}}"""

VIEWS["replies"] = f"""select event_id as k, {_reply_case('event_id', '(event_id % 90)')} as resp
from {{events}}"""

# Empty files, mp4 preference, other suffixes.
VIEWS["manifest"] = """select 's'||cast(page_id % 40 as string) as save_name,
  's'||cast(page_id % 40 as string)||case page_id % 3 when 0 then '.mp4' when 1 then '.jpg' else '_2.webp' end as fname,
  cast((page_id % 7) * 10 as bigint) as size
from {pages}"""

# Prior analyses of documents, for gates.
VIEWS["analyses"] = """select doc_id,
  case quality * 2 + toxic when 0 then 'calm' when 1 then 'GRIM' when 2 then 'Festive' else null end as mood,
  case when doc_id % 5 = 0 then null else toxic = 1 end as indoors,
  cast(quality as bigint) as quality,
  case doc_id % 3 when 0 then '' when 1 then 'because' else null end as caption
from {labels}"""

# Responses: lines are candidates, words are parts.
VIEWS["responses"] = """select conv_id, turn,
  case when turn % 7 = 6 then null else text end as text
from {conversations}"""


def base_tables(text: str) -> set[str]:
    return set(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", text))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in base_tables(text)})


def view_sql(name: str) -> str:
    """The view's text with plain table names."""
    text = VIEWS[name]
    return text.format(**{t: t for t in base_tables(text)})
