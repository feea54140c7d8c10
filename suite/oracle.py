"""The same results in SQL, for DuckDB on the same tables.

Written from the definitions, not from the Spark code: stripping is a regular
expression here, positions are row numbers, attempts are windows.
"""

from __future__ import annotations

from suite.schemas import PROMPT
from suite.views import view_sql

_WS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]+"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_WS}|{_WS}$', '', 'g')"


def clean(c: str) -> str:
    s = strip(f"coalesce({c}, '')")
    return f"(case when lower({s}) = 'nan' then '' else {s} end)"


def normal(c: str) -> str:
    s = strip(f"coalesce({c}, '')")
    return (
        f"(case when {s} like '%/statuses/%' and (lower({s}) like '%x.com%' or lower({s}) like '%twitter.com%') "
        f"then replace({s}, '/statuses/', '/status/') else {s} end)"
    )


def url(c: str) -> str:
    return normal(clean(c))


KEY_SQL = "sha256(" + " || chr(31) || ".join(url(c) for c in ("post_url", "media_url", "platform")) + ")"


def ctes(*named: tuple[str, str] | str) -> str:
    parts = [(n, view_sql(n)) if isinstance(n, str) else n for n in named]
    return "with " + ",\n".join(f"{name} as ({body})" for name, body in parts) + "\n"


KEYED = ("keyed", f"select *, {KEY_SQL} as vlm_content_key from posts")
FIRST = (
    "first_rows",
    "select * exclude (rn) from (select *, row_number() over (partition by post_url order by ordinal) as rn "
    "from keyed) where rn = 1",
)
EARLIER = ("earlier", "select distinct vlm_content_key as k from keyed where ordinal % 3 = 0")
PENDING = ("todo", "select * from first_rows where vlm_content_key not in (select k from earlier)")

_HOST = (
    "lower(regexp_extract(regexp_extract(case when {u} like '%://%' or {u} = '' then {u} else 'https://' || {u} end, "
    "'^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1), '^(?:.*@)?([^:@]*)', 1))"
)


def family(c: str) -> str:
    host = _HOST.format(u=strip(f"coalesce({c}, '')"))
    return (
        f"case when regexp_full_match({host}, '(.*\\.)?instagram\\.com') then 'ig' "
        f"when regexp_full_match({host}, '(.*\\.)?(facebook\\.com|fb\\.com|fb\\.watch|fb\\.me)') then 'fb' end"
    )


def mime(c: str) -> str:
    ext = f"lower(regexp_extract({c}, '[^/.][^/]*(\\.[^./]*)$', 1))"
    return (
        f"case when {c} is null then null else case {ext} when '.mp4' then 'video/mp4' when '.webm' then 'video/webm' "
        "when '.mov' then 'video/quicktime' when '.avi' then 'video/x-msvideo' when '.mkv' then 'video/x-matroska' "
        "when '.jpg' then 'image/jpeg' when '.jpeg' then 'image/jpeg' when '.png' then 'image/png' "
        "when '.gif' then 'image/gif' when '.webp' then 'image/webp' when '.bmp' then 'image/bmp' "
        "when '.svg' then 'image/svg+xml' else 'application/octet-stream' end end"
    )


def clip(c: str, limit: int = 6000) -> str:
    s = strip(f"coalesce({c}, '')")
    return f"(case when length({s}) > {limit} then substr({s}, 1, {limit - 3}) || '...' else {s} end)"


def context(c: str) -> str:
    u = clip(c, 280)
    body = f"replace(replace(replace(replace({u}, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t')"
    return (
        f"('url=' || case when {u} like '%''%' and {u} not like '%\"%' then '\"' || {body} || '\"' "
        f"else '''' || replace({body}, '''', '\\''') || '''' end)"
    )


def failed(video: str, image: str) -> str:
    return f"('Both video (Error: ' || {video} || ') and image (Error: ' || {image} || ') downloads failed.')"


# ------------------------------------------------------------------ routes

DISPATCHED = (
    "dispatched",
    f"""select *, case when p <> '' then p when m <> '' then m end as call_url,
      case when p <> '' then 'post' when m <> '' then 'media' end as url_role,
      case when p <> '' then substr(sha256('post' || chr(10) || p), 1, 16) || '_post'
           when m <> '' then substr(sha256('media' || chr(10) || m), 1, 16) end as save_name
    from (select *, {url('post_url')} as p, {url('media_url')} as m from keyed)""",
)
STORE = (
    "store",
    """select save_name, save_name || case when ordinal % 2 = 0 then '.mp4' else '.jpg' end as fname,
      ordinal % 7 as size from dispatched where save_name is not null and ordinal % 3 <> 0""",
)
FAILURES = (
    "failures",
    f"""select save_name, max({failed("'no video'", "'exit 1 | ' || " + context('call_url'))}) as why
    from dispatched where save_name is not null and ordinal % 5 <> 0 group by save_name""",
)


def picked(source: str) -> str:
    return f"""select save_name, coalesce(min(fname) filter (fname = save_name || '.mp4'), min(fname)) as media_fname
      from {source} where size > 0 and starts_with(fname, save_name) group by save_name"""


ROUTED = (
    "routed",
    f"""select d.* exclude (p, m), f.media_fname,
      case when f.media_fname is null then w.why end as download_error,
      case when f.media_fname is not null then d.url_role when d.call_url is not null then 'url' else 'None' end
        as url_used,
      {mime('f.media_fname')} as mime
    from dispatched d left join ({picked('store')}) f using (save_name) left join failures w using (save_name)""",
)
ROUTES = ("posts", KEYED, DISPATCHED, STORE, FAILURES, ROUTED)

# ------------------------------------------------------------------ errors


def has(c: str, *marks: str) -> str:
    return "(" + " or ".join(f"contains(lower({c}), '{m}')" for m in marks) + ")"


def delay(c: str) -> str:
    def part(pattern: str, i: int) -> str:
        return f"try_cast(nullif(regexp_extract({c}, '{pattern}', {i}, 'i'), '') as double)"

    short, long = r"retry in (\d+\.?\d*)s\b", r"retry in (\d+)h(\d+)m(\d+\.?\d*)s"
    hours = f"{part(long, 1)} * 3600 + {part(long, 2)} * 60 + {part(long, 3)}"
    return f"coalesce({part(short, 1)}, {hours})"


def retryable(c: str) -> str:
    return f"coalesce({has(c, '500', 'internal', 'failed to convert server response to json')}, false)"


def exhausted(c: str) -> str:
    return f"coalesce({has(c, '429', 'resource exhausted', 'resource_exhausted', 'quota', 'rate limit')}, false)"


def per_minute(c: str) -> str:
    return f"({exhausted(c)} and not {has(c, 'per_day', 'perday')} and coalesce({delay(c)} < 3600, false))"


def daily(c: str) -> str:
    return (
        f"({exhausted(c)} and ({has(c, 'per_day', 'perday', 'per-day')} "
        f"or ({has(c, 'per day')} and {has(c, 'quota', 'limit')}) or coalesce({delay(c)} >= 3600, false)))"
    )


STATUS = """case when coalesce(resp, '') = '' then 'empty' when not json_valid(resp) then 'bad_json'
  when json_type(resp) <> 'OBJECT' then 'not_object' else 'ok' end"""
STATUS_ERROR = f"""case {STATUS} when 'empty' then 'Empty response from Gemini'
  when 'bad_json' then 'Invalid JSON in reply' when 'not_object' then 'Unexpected response JSON structure' end"""


def with_errors(source: str) -> str:
    return f"select * exclude (err), coalesce(err, {STATUS_ERROR}) as err from {source}"


FINAL = f"(err is null or not ({per_minute('err')} or {retryable('err')}) or attempt >= 2)"


def outcome(source: str, by: str) -> str:
    """First final attempt, else the last one there is."""
    return f"""select * exclude (final, rn) from (
      select *, row_number() over (partition by {by} order by final desc,
        case when final then attempt else -attempt end) as rn
      from (select *, {FINAL} as final from {source})) where rn = 1"""


def decided(log: str) -> str:
    """Outcome over both models, one row per ``k``."""
    return f"""select k, decision,
      case decision when 'fallback' then f_resp when 'fallback_only' then f_resp else p_resp end as resp,
      case when decision in ('fallback', 'fallback_only') then
        case when f_seen is null then 'Unknown error' else f_err end else p_err end as err,
      case when decision in ('fallback', 'fallback_only') then 'fallback' else 'primary' end as model_used
    from (select *, case when p_seen is null then 'fallback_only' when p_err is null then 'ok'
        when {daily('p_err')} then 'stop_daily' when {exhausted('p_err')} then 'fallback' else 'error' end as decision
      from (select coalesce(p.k, f.k) as k, p.attempt as p_seen, p.err as p_err,
          case when p.err is null then p.resp end as p_resp,
          f.attempt as f_seen, f.err as f_err, case when f.err is null then f.resp end as f_resp
        from ({outcome(f"(select * from {log} where model = 'primary')", 'k')}) p
        full join ({outcome(f"(select * from {log} where model = 'fallback')", 'k')}) f on p.k = f.k))"""


# ------------------------------------------------------------------ replies


def raw(f: str) -> str:
    return f"json_extract_string(j, '$.{f}')"


def truth(path: str, j: str = "j") -> str:
    t = f"json_extract({j}, '{path}')"
    return f"""case json_type({t}) when 'NULL' then null when 'BOOLEAN' then cast({t} as varchar) = 'true'
      when 'VARCHAR' then json_extract_string({j}, '{path}') <> '' when 'ARRAY' then json_array_length({t}) > 0
      when 'OBJECT' then len(json_keys({t})) > 0 else cast({t} as double) <> 0 end"""


LEVELS = "('FESTIVE', 'LIVELY', 'CALM', 'GRIM')"
LEVEL = f"""case when upper({raw('mood')}) in {LEVELS} then upper({raw('mood')})
  when {raw('mood')} is not null then 'FESTIVE' when j is not null then 'CALM' end"""
INDOORS = f"case when {raw('indoors')} is null then false else {truth('$.indoors')} end"
OBJECTS = "coalesce(array_to_string(cast(json_extract(j, '$.objects') as varchar[]), ','), '')"


def typed(source: str) -> str:
    """Adds ``j`` (an object or null) and the typed fields."""
    return f"""select *, {LEVEL} as mood, {raw('caption')} as caption,
      try_cast({raw('score')} as double) as score,
      case when j is not null then {INDOORS} end as indoors, case when j is not null then {OBJECTS} end as objects,
      json_extract_string(j, '$.spot.country') as country, json_extract_string(j, '$.spot.city') as city,
      coalesce(json_type(json_extract(j, '$.spot')) = 'OBJECT', false) as has_spot,
      case when j is not null then coalesce({raw('lang')}, 'und') end as lang
    from (select *, case when {STATUS} = 'ok' then json(resp) end as j from {source})"""


def quoted(c: str) -> str:
    return f"coalesce(cast(to_json({c}) as varchar), 'null')"


def full_json() -> str:
    spot = (
        f"""case when has_spot then '{{"country":' || {quoted('country')} || ',"city":' || {quoted('city')} || '}}' """
        "else 'null' end"
    )
    objects = """case when objects = '' then '[]' else '["' || replace(objects, ',', '","') || '"]' end"""
    parts = [
        ("caption", quoted("caption")), ("score", "coalesce(cast(score as varchar), 'null')"), ("mood", quoted("mood")),
        ("objects", objects), ("spot", spot), ("indoors", "cast(indoors as varchar)"), ("lang", quoted("lang")),
    ]
    body = " || ',' || ".join(f"""'"{n}":' || {e}""" for n, e in parts)
    return f"('{{' || {body} || '}}')"


# ------------------------------------------------------------------ scored posts


def routed_calls(posts: str, used: str, shift: int = 0) -> str:
    return f"""select c.* replace (c.k + {shift} as k) from calls c join {posts} r on r.ordinal = c.k + {shift}
      where r.{used} in ('post', 'media') or (r.{used} = 'url' and c.model = 'fallback')"""


SCORED = (
    *ROUTES,
    ("batch", "select * exclude (rn) from (select *, row_number() over (partition by post_url order by ordinal) as rn "
              "from routed) where rn = 1"),
    "calls",
    ("log1", with_errors(f"({routed_calls('routed', 'url_used')})")),
    ("outcomes", decided("log1")),
    ("scored", typed("(select b.*, o.resp, o.err, o.model_used from batch b left join outcomes o on b.ordinal = o.k)")),
    (
        "results",
        f"""select *, case when url_used <> 'None' then model_used end as vlm_model_used,
          case when url_used <> 'None' then download_error end as vlm_download_error_before_url,
          case when j is not null then {full_json()} end as vlm_full_response_json,
          case when j is null then case when url_used = 'None' then 'No media_url or post_url available to download.'
            when coalesce(download_error, '') <> '' then 'File download failed (' || download_error || '). URL-only: '
              || coalesce(nullif(err, ''), 'Unknown error')
            else coalesce(nullif(err, ''), 'Unknown error') end end as vlm_error
        from scored""",
    ),
)

NOTE_JSON = f"""('{{"caption":' || {quoted('caption')} || ',"lang":' || {quoted('lang')} || ',"indoors":'
  || coalesce(cast({truth('$.indoors')} as varchar), 'null') || '}}')"""

ANNOTATED = (
    *SCORED,
    ("wanted", "select ordinal, url_used from results where j is not null and mood in ('FESTIVE', 'LIVELY')"),
    ("log2", with_errors(f"({routed_calls('wanted', 'url_used', 1)})")),
    ("outcomes2", decided("log2")),
    ("notes", f"""select k, err, model_used, case when j is not null then {NOTE_JSON} end as note
      from ({typed('outcomes2')})"""),
    (
        "annotated",
        """select r.*, n.note as vlm_annotation_json, case when n.note is null then n.err end as vlm_annotation_error,
          n.model_used as vlm_annotation_model_used from results r left join notes n on r.ordinal = n.k""",
    ),
)

# ------------------------------------------------------------------ the stub client

MEDIA_PROMPT = f"'{PROMPT}' || chr(10) || chr(10) || 'Original URL: ' || call_url || chr(10)"
URL_PROMPT = (
    f"'{PROMPT}' || chr(10) || chr(10) || 'We could not download the media. Please analyze based on the following "
    "URL: ' || call_url || chr(10) || 'If you cannot access or analyze the content from this URL, return an error.'"
)
STUBBED = """case substr(h, 1, 1) when '3' then '403 permission denied' when '4' then 'Invalid JSON in reply' end"""

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str, *named: tuple[str, str] | str) -> None:
    ORACLE[name] = (ctes(*named) if named else "") + sql


POSTS = ("posts", KEYED)

oracle(
    "scan_posts",
    "select ordinal, html, " + ", ".join(
        f"case when {c} in ('', 'NaN', 'nan', 'null', 'NULL', 'None', 'NA', 'N/A', 'n/a') then null else {c} end as {c}"
        for c in ("post_url", "media_url", "platform")
    ) + " from posts join pages on page_id = ordinal", "posts",
)
oracle("clean_text", f"select ordinal, {clean('post_url')} as post_url, {clean('media_url')} as media_url, "
                     f"{clean('platform')} as platform from posts", "posts")
oracle("normalize_url", f"select ordinal, {normal('post_url')} as post_url, {url('post_url')} as post_url_clean "
                        "from posts", "posts")
oracle("content_key", "select ordinal, vlm_content_key from keyed", *POSTS)
oracle(
    "media_save_name",
    f"""select ordinal, substr(sha256('post' || chr(10) || {url('post_url')}), 1, 16) || '_post' as post_name,
    substr(sha256('media' || chr(10) || {strip('media_url')}), 1, 16) as media_name from posts""", "posts",
)
oracle("host_family", f"select ordinal, {family('post_url')} as post_url, {family('media_url')} as media_url from posts",
       "posts")
oracle(
    "mime_type",
    f"""select fname, {mime('fname')} as mime from manifest union all
    select media_url, {mime('media_url')} from posts""", "posts", "manifest",
)
oracle("clip_text", f"select doc_id, {clip('text')} as clipped from documents")
oracle("download_error", f"select doc_id, {failed('source', clip('text') + chr(32) + '|| chr(32) || chr(124) || chr(32) || ' + context('text'))} as message from documents")
oracle("dedup_first", "select * exclude (vlm_content_key) from first_rows", *POSTS, FIRST)
oracle("processed_keys", "select k as vlm_content_key from earlier", *POSTS, EARLIER)
oracle("pending", "select * from todo", *POSTS, FIRST, EARLIER, PENDING)
oracle(
    "sorted_queue",
    """select *, row_number() over (order by platform asc nulls last, media_url desc nulls last, ordinal) - 1 as pos
    from posts""", "posts",
)
oracle(
    "batch_pos",
    """select row_number() over (order by platform asc nulls last, ordinal) - 1 as pos, ordinal, vlm_content_key
    from todo""", *POSTS, FIRST, EARLIER, PENDING,
)
oracle(
    "top_per_group",
    """select * exclude (vlm_content_key, rn) from (select *, row_number() over (partition by platform order by ordinal)
    as rn from first_rows where platform is not null) where rn <= 2""", *POSTS, FIRST,
)
oracle(
    "top_per_group_large",
    """select * exclude (rn) from (select *, row_number() over (partition by platform order by likes desc, ordinal)
    as rn from bulk_posts) where rn <= 5000""", "bulk_posts",
)
oracle("limit_n", "select * from posts order by media_url desc nulls last, ordinal limit 20", "posts")
oracle("shuffled", "select row_number() over (order by sha256(vlm_content_key || '|7'), ordinal) - 1 as pos, ordinal "
                   "from keyed", *POSTS)
oracle(
    "chunk_ids",
    """select ordinal, pos, pos // 100 as chunk_id from (
    select ordinal, row_number() over (order by platform, ordinal) - 1 as pos from bulk_posts)""", "bulk_posts",
)
oracle(
    "bulk_queue",
    """select platform, count(*) as n_rows, min(ordinal) as first, max(ordinal) as last,
      min(vlm_content_key) as min_key
    from (select *, row_number() over (partition by platform order by ordinal) as place from first_rows
      where vlm_content_key not in (select vlm_content_key from keyed where likes > 45)) where place <= 500
    group by platform""", ("posts", view_sql("bulk_posts")), KEYED, FIRST,
)
oracle(
    "media_resolve",
    f"""select page_id, save_name, media_fname from (select page_id, 's' || (page_id % 50) as save_name from pages)
    left join ({picked('manifest')}) using (save_name)""", "manifest",
)
oracle("url_dispatch", "select ordinal, url_used, call_url, save_name, media_fname, mime, download_error from routed",
       *ROUTES)
oracle(
    "error_class",
    f"""select k, attempt, {retryable('err')} as retryable, {exhausted('err')} as exhausted,
    {per_minute('err')} as per_minute, {daily('err')} as daily
    from (select k, attempt, err from attempts)""".replace("not (contains", "not coalesce(contains"), "attempts",
)
oracle("retry_delay", f"select k, attempt, {delay('err')} as delay_sec from attempts", "attempts")
oracle("attempt_log", with_errors("calls"), "calls")
oracle("attempt_outcome", f"select k, attempt, resp, err from ({outcome('log', 'k')})", "attempts",
       ("log", with_errors("attempts")))
oracle(
    "retry_wait",
    f"""select l.k, cast(sum(case when {per_minute('l.err')} then {delay('l.err')} + 5
      when {retryable('l.err')} and l.attempt < 2 then 2 * power(2, l.attempt) else 0 end) as double) as wait_sec
    from log l join ({outcome('log', 'k')}) o on l.k = o.k and l.attempt <= o.attempt group by l.k""", "attempts",
    ("log", with_errors("attempts")),
)
oracle("fallback_decision", decided("log"), "calls", ("log", with_errors("calls")))
oracle(
    "quota_stop",
    f"""select * from joined where pos <= coalesce((select min(pos) from joined
      where model = 'primary' and {daily('err')}), 9223372036854775807)""", "calls",
    ("joined", """select event_id as pos, user_id, model, err from events left join calls
      on event_id = k * 6 + case when model = 'primary' then 0 else 3 end + attempt + 40"""),
)
oracle("text_parts", "select conv_id, turn, nullif(replace(replace(text, chr(10), ''), ' ', ''), '') as resp "
                     "from responses", "responses")
oracle("saved_responses", "select conv_id, turn, coalesce(text, '') || role as resp from conversations")
oracle("reply_status", f"select k, {STATUS} as status, {STATUS_ERROR} as error from replies", "replies")
oracle(
    "parse_reply",
    f"""select k, j is not null as ok, mood, caption, score, indoors, objects, country, city, lang
    from ({typed('replies')})""", "replies",
)
oracle(
    "enum_coerce",
    """select event_id, case event_type when 'click' then 'CLICK' when 'view' then 'view' else 'CLICK' end as coerced,
    event_type not in ('click', 'view') as fell_back,
    case when event_type in ('error', 'purchase') then upper(event_type) when event_type = 'view' then 'view' else 'SIGNUP' end as level
    from events""",
)
oracle("bool_coerce", f"select k, {truth('$.indoors', 'v')} as indoors from (select k, case when json_valid(resp) "
                      "then json(resp) end as v from replies)", "replies")
oracle("full_json", f"select k, {full_json()} as json from ({typed('replies')}) where j is not null", "replies")
oracle(
    "annotation_gate",
    """select doc_id, coalesce(upper(mood) = 'CALM', false) as by_enum, coalesce(indoors, false) as by_bool,
      coalesce(upper(mood) = 'FESTIVE' and not indoors, false) as by_both, coalesce(quality = 1, false) as by_number,
      coalesce(caption = 'because', false) as by_text, coalesce(caption <> '', false) as by_truth,
      false as by_unknown, true as by_default, coalesce(quality = 0, false) as by_criteria, false as off
    from analyses""", "analyses",
)
oracle("prompt_first", f"select ordinal, case when media_fname is not null then {MEDIA_PROMPT} else {URL_PROMPT} end "
                       "as prompt from routed", *ROUTES)
oracle(
    "prompt_annotation",
    f"""select ordinal, 'Post {{"vlm_content_key":"' || vlm_content_key || '","prior_analysis":' || {full_json()}
      || '}} with {{braces}}' || chr(10) || 'row {{"ordinal":' || ordinal || ',"post_url":' || {quoted('post_url')}
      || ',"media_url":' || {quoted('media_url')} || ',"platform":' || {quoted('platform')} || '}}' || chr(10)
      || 'at ' || coalesce(call_url, '(none)') as prompt
    from scored where j is not null and call_url is not null""", *SCORED,
)
oracle("first_pass", "select ordinal, vlm_content_key, url_used, model_used, err, j is not null as has_analysis "
                     "from scored", *SCORED)
oracle(
    "result_ok",
    """select ordinal, post_url, media_url, platform, vlm_content_key, url_used as vlm_url_used, vlm_model_used,
      vlm_download_error_before_url, mood as vlm_mood, caption as vlm_caption,
      score as vlm_score, indoors as vlm_indoors, lang as vlm_lang, vlm_full_response_json, vlm_error
    from results where vlm_error is null""", *SCORED,
)
oracle(
    "result_error",
    """select ordinal, vlm_content_key, url_used as vlm_url_used, vlm_model_used, vlm_error,
      vlm_download_error_before_url, cast(null as varchar) as vlm_mood,
      cast(null as varchar) as vlm_full_response_json from results where vlm_error is not null""", *SCORED,
)
oracle("annotate", "select ordinal, vlm_annotation_json, vlm_annotation_error, vlm_annotation_model_used "
                         "from annotated", *ANNOTATED)
oracle(
    "annotation_sink_rows",
    """select vlm_content_key, vlm_annotation_json, vlm_annotation_error, vlm_annotation_model_used from annotated
    where coalesce(vlm_annotation_json, '') <> '' or coalesce(vlm_annotation_error, '') <> ''""", *ANNOTATED,
)
oracle(
    "column_order",
    """select ordinal, coalesce(platform, '-') || '|' || ordinal || '|' || coalesce(media_url, '-') || '|a|b|'
      || vlm_content_key || '|-' as row_text from keyed""", *POSTS,
)
oracle(
    "header_reconcile",
    """select ordinal, platform, post_url, url, ordinal || '|' || coalesce(platform, '-') || '|'
      || coalesce(post_url, '-') || '|' || coalesce(url, '-') as row_text
    from (select ordinal, platform, post_url, null::varchar as url from posts
      union all select page_id + 1000000000, 'web', null, url from pages)""", "posts",
)
oracle(
    "cell_text",
    """select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || case when microsecond(ts) % 1000000 = 0 then ''
        else '.' || lpad((microsecond(ts) % 1000000)::varchar, 6, '0') end as ts_text,
      cast(value as varchar) as value_text, cast(value * 1e7 as varchar) as large_text,
      cast(value / 1e5 as varchar) as small_text, upper((value > 20)::varchar) as big_text,
      case when event_id % 3 > 0 then props else '' end as props_text from events""",
)
oracle(
    "run_summary",
    """select platform, case when vlm_error is null then 'ok' else 'error' end as status, count(*) as n_rows
    from results group by 1, 2""", *SCORED,
)
oracle(
    "sink_roundtrip",
    """select ordinal, vlm_content_key, vlm_error, score as vlm_score, indoors as vlm_indoors, lang as vlm_lang,
      case when ordinal % 2 = 1 then 'new' end as vlm_note, city from results""", *SCORED,
)
oracle(
    "mirror_sink",
    """select ordinal::varchar as ordinal, platform, vlm_content_key, vlm_error, vlm_full_response_json,
      indoors::varchar as vlm_indoors, sink from results, (select unnest(['primary', 'mirror']) as sink)""", *SCORED,
)
# ------------------------------------------------------------------ whole runs

NO_FAILURES = ("failures", "select null::varchar as save_name, null::varchar as why where false")
UNTIL_ROUTED = ("posts", KEYED, DISPATCHED, STORE, NO_FAILURES, ROUTED)
DAILY = "'429 quota exceeded: GenerateRequestsPerDay retry in 14h30m13.78s'"


def stubbed(batch: str) -> tuple[str, str]:
    """What the stub makes of the rows of ``batch``: ``h`` picks its reply, ``why`` is the error."""
    return (
        "answers",
        f"""select *, case when url_used = 'None' then 'No media_url or post_url available to download.'
            else {STUBBED} end as why
          from (select *, sha256(case when media_fname is not null then {MEDIA_PROMPT} else {URL_PROMPT} end) as h
            from {batch})""",
    )


RUN_ROWS = """ordinal, vlm_content_key, platform, url_used as vlm_url_used,
  case when url_used = 'None' then null when media_fname is null or (substr(h, 1, 1) = '2' and not {spent}) then 'fallback'
    else 'primary' end as vlm_model_used,
  case when {why} is null then case ('0x' || substr(h, 2, 1))::int % 4 when 0 then 'FESTIVE' when 1 then 'LIVELY'
    when 2 then 'CALM' else 'GRIM' end end as vlm_mood,
  case when {why} is null then substr(h, 1, 6) end as vlm_caption, {why} as vlm_error"""
PLAIN_ROWS = RUN_ROWS.format(why="why", spent="false")
SPENT_ROWS = RUN_ROWS.format(why=f"(case when pos = stop then {DAILY} else why end)", spent="coalesce(pos = stop, false)")

ONCE = (
    *UNTIL_ROUTED,
    ("once", "select * exclude (rn) from (select *, row_number() over (partition by vlm_content_key order by ordinal) as rn "
             "from routed) where rn = 1"),
    ("single", "select * exclude (rn) from (select *, row_number() over (partition by post_url order by ordinal) as rn "
               "from once) where rn = 1"),
    stubbed("single"),
)
QUOTA = (
    *ONCE,
    ("placed", "select *, row_number() over (order by platform nulls last, ordinal) - 1 as pos from answers"),
    ("stopping", "select *, min(pos) filter (media_fname is not null and pos >= 20) over () as stop from placed"),
)
PASSES = (*UNTIL_ROUTED, SCORED[len(ROUTES)], stubbed("batch"))
FESTIVE = "why is null and ('0x' || substr(h, 2, 1))::int % 4 = 0"

oracle("resume_run", f"select {PLAIN_ROWS}, 0::bigint as left_over from answers", *PASSES)
oracle("resume_after_crash", f"select {PLAIN_ROWS}, 0::bigint as repeated_calls from answers", *ONCE)
oracle("run_quota_stop", f"select {SPENT_ROWS}, stop as stopped_at from stopping where pos <= coalesce(stop, pos)", *QUOTA)
oracle("quota_waves", f"select {SPENT_ROWS}, stop as stopped_at, true as within_one_wave from stopping where pos <= coalesce(stop, pos)",
       *QUOTA)
oracle("quota_resume", f"select {SPENT_ROWS}, 0::bigint as answered_twice from stopping", *QUOTA)
oracle(
    "run_two_pass",
    f"""select ordinal, vlm_content_key, case when why is null then case ('0x' || substr(h, 2, 1))::int % 4
        when 0 then 'FESTIVE' when 1 then 'LIVELY' when 2 then 'CALM' else 'GRIM' end end as vlm_mood, why as vlm_error,
      case when {FESTIVE} then '{{"caption":' || {quoted('call_url')} || ',"lang":"'
        || coalesce('s3a://media/store/' || save_name || '/' || media_fname, 'und') || '","indoors":true}}' end
        as vlm_annotation_json, null::varchar as vlm_annotation_error,
      case when {FESTIVE} then case when media_fname is null then 'fallback' else 'primary' end end
        as vlm_annotation_model_used,
      count(*) filter ({FESTIVE}) over () as n_annotations, count(*) over () as n_mirror
    from answers""", *PASSES,
)
oracle(
    "commit_repair",
    f"""select sink, vlm_content_key, count(*) as n_rows from answers, (select unnest(['results', 'mirror', 'annotations'])
      as sink) where sink <> 'annotations' or ({FESTIVE}) group by 1, 2""", *PASSES,
)
oracle(
    "commit_ledger",
    f"""select lost_after, sink, vlm_content_key, 0::bigint as open_chunks, count(*) as n_rows
    from answers, (select unnest(['results', 'mirror', 'annotations']) as sink),
      (select unnest(['staged', 'results', 'annotations', 'mirror']) as lost_after)
    where sink <> 'annotations' or ({FESTIVE}) group by 1, 2, 3""", *PASSES,
)
oracle(
    "media_lookup",
    f"""select d.ordinal, f.media_fname, d.save_name || '/' || f.media_fname as media_place,
      case when f.media_fname is not null then d.url_role when d.call_url is not null then 'url' else 'None' end as url_used,
      {mime('f.media_fname')} as mime
    from dispatched d left join ({picked('written')}) f using (save_name)""",
    "posts", KEYED, DISPATCHED,
    ("written", """select distinct save_name, save_name || case when ordinal % 2 = 0 then '.mp4' else '_1.jpg' end as fname,
      1 as size from dispatched where save_name is not null and ordinal % 3 < 2"""),
)
oracle(
    "stream_resume",
    "select vlm_content_key, count(distinct vlm_content_key) as n_rows from first_rows group by 1", "posts", KEYED, FIRST,
)


# The first four hex digits of the key as a number, modulo 64, as ``log_bucket``.
HEX_BUCKET = " + ".join(f"(instr('0123456789abcdef', substr(h, {i}, 1)) - 1) * {16 ** (4 - i)}" for i in range(1, 5))
oracle("log_compaction", f"""select cast(({HEX_BUCKET}) % 64 as integer) as bucket, 1::bigint as n_files,
    count(*) as n_rows, count(distinct h) as n_keys, count(resp) as n_replies, count(err) as n_errors,
    3::bigint as rounds_merged, 0::bigint as left_over
  from (select sha256(cast(k as varchar)) as h, resp, err from calls) group by 1""", "calls")
oracle(
    "stream_state",
    "select vlm_content_key, count(distinct vlm_content_key) as n_rows from first_rows group by 1", "posts", KEYED, FIRST,
)
oracle(
    "rate_schedule",
    """select k, model, attempt, rate_rank,
      60.0 * floor(greatest(rate_rank - 3, 0) / case model when 'primary' then 7 when 'fallback' then 5 else 1 end) as ready_at
    from (select k, model, attempt, row_number() over (partition by model order by k * 3 + attempt) - 1 as rate_rank
      from calls)""", "calls",
)
