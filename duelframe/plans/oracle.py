"""The queries' results as ANSI SQL, written from their meaning and not from the plans."""

from __future__ import annotations

from duelframe.operators.dims import ALIASES
from duelframe.plans.fixtures import ALL_EVENTS, EVENTS, UPLOADS

# The patterns as the survey states them, on their own: a slip in the library's shows as a difference.
LEAGUE = "Bar League"
PART = r"\s*pt\.?\s*(\d+)$"
VS, WORD_VS, WORD_AND = r"\s+vs\s+", r"\bvs\b", r"\band\b"
DATE = r"(Jan(?:uary)?\.?|Feb(?:ruary)?\.?|Mar(?:ch)?\.?|Apr(?:il)?\.?|May\.?|Jun(?:e)?\.?|Jul(?:y)?\.?|Aug(?:ust)?\.?|Sep(?:t\.?|tember)\.?|Oct(?:ober)?\.?|Nov(?:ember)?\.?|Dec(?:ember)?\.?)\s+(\d{1,2})(?:\s*-\s*\d{1,2})?\s*,\s*(\d{4})"
PREFIX = rf"^{LEAGUE}(?: [^–-]+)?\s*[-–]\s*"
PLACE_PREFIX = rf"^({LEAGUE}(?: Battle League)?(?: presents)?[:\-]?\s*)"
EVENT_NAME = rf"{LEAGUE}\s+presents\s*:?\s*(.+?)\s*@"
# Titles that hold one of these, in any case, are no battles.
KEYWORDS = [
    "tryout", "tryouts", "beatbox", "beat box", "flyer", "promo", "promos", "anygma machine", "unggoyan", "pre-battle interviews", "interview",
    "interviews", "salitang ugat", "trailer", "video flyer", "[live]", "silip", "sound check", "tribute", "anniversary party", "tutok", "review", "abangan",
]


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _sub(x: str, pattern: str, by: str = "", flags: str = "i") -> str:
    return f"regexp_replace({x}, {_text(pattern)}, '{by}', '{flags}')"


def _has(x: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({x}, {_text(pattern)}, 'i'), false)"


def _count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {_text(pattern)}))"


_PREFIX = PREFIX


def _date(x: str) -> str:
    """The first date of x as a timestamp."""
    part = lambda k: f"regexp_extract({x}, {_text(DATE)}, {k}, 'i')"
    month = "case lower(substring(" + part(1) + ", 1, 3)) " + " ".join(f"when '{m}' then '{k + 1}'" for k, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())) + " end"
    return f"cast(try_strptime({part(3)} || '-' || {month} || '-' || {part(2)}, '%Y-%m-%d') as timestamp)"


def _place(x: str) -> str:
    """What stands before the first date of x, after the last colon."""
    before = f"regexp_extract({x}, {_text('^(.*?)' + DATE)}, 1, 'is')"
    after = _strip(rf"regexp_extract({before}, '([^:]*)$', 1, 's')")
    return f"nullif(case when {_has(x, DATE)} then trim({after}, ' .') else {_strip(x)} end, '')"


def _clean_place(x: str) -> str:
    last = lambda y, mark: _strip(f"regexp_extract({y}, '([^{mark}]*)$', 1, 's')")
    plain = _strip(x)
    sentence = last(last(last(plain, "."), "!"), "?")
    place = _sub(f"case when contains({plain}, '@') then {last(plain, '@')} else {sentence} end", PLACE_PREFIX)
    return f"nullif(trim(regexp_replace({place}, '\\s+', ' ', 'g'), e' \\t\\n\\r-–,.;:'), '')"


def _event_name(x: str) -> str:
    flat = rf"regexp_replace({x}, '\s+', ' ', 'g')"
    return f"nullif(trim(regexp_extract({flat}, {_text(EVENT_NAME)}, 1, 'i'), ' -–—'), '')"


def _clock(s: str) -> str:
    return f"strftime(to_timestamp(floor({s})) at time zone 'UTC', '%H:%M:%S')"


def _listed(c: str) -> str:
    """A CSV's list: of a battle in parts ['a', 'b'], else the value."""
    return f"case when is_multipart then '[' || chr(39) || replace({c}, ' | ', chr(39) || ', ' || chr(39)) || chr(39) || ']' else {c} end"


def _json(c: str) -> str:
    return f"case when is_multipart then cast(to_json(string_split({c}, ' | ')) as varchar) else {c} end"


def _stamp(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def _fixed_place(c: str) -> str:
    return rf"regexp_replace(regexp_replace({c}, '^Davao City,\s*Metro Manila,\s*Philippines$', 'Davao City, Philippines'), '^Davao City$', 'Davao City, Philippines')"


_NUMBER = r"([0-9]+(?:[.,][0-9]+)?)"
_DURATION = rf"^P(?:{_NUMBER}D)?(?:T(?:{_NUMBER}H)?(?:{_NUMBER}M)?(?:{_NUMBER}S)?)?$"
_SECONDS = " + ".join(f"coalesce(try_cast(replace(regexp_extract(duration, '{_DURATION}', {k + 1}), ',', '.') as double), 0) * {s}" for k, s in enumerate((86400, 3600, 60, 1)))

CHAIN = rf"""
with uploads_fx as ({UPLOADS}),
events_fx as ({EVENTS}),
alias(a, c) as (values {", ".join(f"({_text(a)}, {_text(c)})" for a, c in ALIASES.items())}),
cleaned as (
  select * replace ({_sub(_strip("title"), '^"(.*)"$', chr(92) + "1", "")} as title,
                    try_cast(replace(upload_date, 'Z', '') as timestamp) as upload_date),
    case when regexp_matches(duration, '{_DURATION}') and regexp_matches(duration, '\d') then {_SECONDS} end as duration_seconds
  from uploads_fx),
titled as (
  select * replace ({_strip(_sub(_strip("title"), PART))} as title), title as yt_raw_title, {_clock("duration_seconds")} as duration_hms,
    try_cast(regexp_extract(title, {_text(PART)}, 1, 'i') as integer) as part, {_has("title", PART)} as is_part
  from cleaned),
flagged as (
  select *, {_has("title", WORD_VS)} as has_vs, coalesce({" or ".join(f"contains(lower(title), {_text(w)})" for w in KEYWORDS)}, false) as excluded,
    title is not null and {_count("lower(title)", WORD_VS)} <= 1 and {_count("lower(title)", WORD_AND)} <= 1
      and not contains(title, '/') and not contains(title, '+') and not {_has("title", r"\b\d+\s*on\s*\d+\b")} as single,
    {_sub(_strip("title"), _PREFIX)} as body
  from titled),
sided as (
  select *, nullif({_strip("regexp_extract(body, '^(.*?)" + chr(92) + "s+vs" + chr(92) + "s+', 1, 'is')")}, '') as l,
    nullif({_strip(_sub(_sub(_strip("regexp_extract(body, '^.*?" + chr(92) + "s+vs" + chr(92) + "s+(.*)$', 1, 'is')"), r"\s*[@|(*].*$", "", ""), r"\s+\d+$", "", ""))}, '') as r
  from flagged),
matched as (
  select *, l || ' vs ' || r as found, {_sub("l || ' vs ' || r", r"\s-\s.*$", "", "")} as matchup from sided),
split as (
  select *, case when {_has("matchup", VS)} then {_strip("regexp_extract(matchup, '^(.*?)" + chr(92) + "s+vs" + chr(92) + "s+', 1, 'i')")} else {_strip("matchup")} end as emcee1,
    case when {_has("matchup", VS)} then {_strip("regexp_extract(matchup, '^.*?" + chr(92) + "s+vs" + chr(92) + "s+(.*)$', 1, 'i')")} end as emcee2
  from matched),
named as (
  select split.* replace (coalesce(x.c, emcee1) as emcee1, coalesce(y.c, emcee2) as emcee2), coalesce(x.c, emcee1) || ' vs ' || coalesce(y.c, emcee2) as matchup_clean
  from split left join alias x on emcee1 = x.a left join alias y on emcee2 = y.a),
one_on_one as (select * from named where has_vs and not excluded and single),
described as (
  select *, {_date("event_description")} as event_date, {_place("event_description")} as event_location, {_clean_place(_place("event_description"))} as event_location_clean
  from events_fx),
first_event as (
  select video_id, arg_min(struct_pack(n := event_name, d := event_date, p := event_location_clean), _ord) as e
  from described where video_id is not null group by video_id),
joined as (
  select u.*, e.n as name0, e.p as place0, case when upload_date between '2020-05-01' and '2022-04-27' then null else e.d end as date0
  from one_on_one u left join first_event f on u.id = f.video_id),
attached as (
  select *, coalesce(name0, case when date0 is null and upload_date > '2022-05-01' then {_event_name("description")} end) as event_name,
    coalesce(date0, case when upload_date > '2022-05-01' then {_date("description")} end) as event_date,
    coalesce(place0, case when date0 is null and upload_date > '2022-05-01' then {_clean_place(_place("description"))} end) as event_location
  from joined),
grouped as (
  select {_strip(_sub(_strip("yt_raw_title"), PART))} as base, string_agg(id, ' | ' order by part, yt_raw_title, id) as id, string_agg(url, ' | ' order by part, yt_raw_title, id) as url,
    min(upload_date) as upload_date, coalesce(sum(duration_seconds), 0) as duration_seconds,
    {", ".join(f"arg_min({c}, (part, yt_raw_title, id)) filter ({c} is not null) as {c}" for c in ("description", "title", "yt_raw_title", "emcee1", "emcee2", "matchup_clean", "event_name", "event_date", "event_location"))}
  from attached where is_part group by all),
whole as (
  select id, url, upload_date, duration_seconds, description, title, yt_raw_title, emcee1, emcee2, matchup_clean, event_name, event_date, event_location, false as is_multipart from attached where not is_part
  union all
  select id, url, upload_date, duration_seconds, description, title, yt_raw_title, emcee1, emcee2, matchup_clean, event_name, event_date, event_location, true from grouped),
battles as (
  select id, title, description, upload_date, duration_seconds, {_clock("duration_seconds")} as duration_hms, emcee1, emcee2, matchup_clean as matchup, event_name, event_date,
    regexp_replace(regexp_replace(event_location, '^Davao City,\s*Metro Manila,\s*Philippines$', 'Davao City, Philippines'), '^Davao City$', 'Davao City, Philippines') as event_location, url
  from whole)
"""

def _attached(key: str, met: str) -> str:
    """Columns and tables of uploads joined to the first event of their id; those whose id ends in 7 have none."""
    date = f"case when upload_date between '2020-05-01' and '2022-04-27' then null else (e).d end"
    fill = f"{date} is null and upload_date > '2022-05-01'"
    return f"""coalesce((e).n, case when {fill} then {_event_name("description")} end) as event_name,
      coalesce({date}, case when upload_date > '2022-05-01' then {_date("description")} end) as event_date,
      coalesce((e).p, case when {fill} then {_clean_place(_place("description"))} end) as event_location_clean
      from one_on_one u left join {met} f on {key} = f.video_id"""


_OWN_ID = "case when u.id like '%7' then null else u.id end"
_WITHOUT_IDS = _attached(_OWN_ID, "first_event")
_EACH_KEY = "(select coalesce(video_id, '') as video_id, arg_min(struct_pack(n := event_name, d := event_date, p := event_location_clean), _ord) as e from described group by 1)"
_NULL_IDS = _attached(f"coalesce({_OWN_ID}, '')", _EACH_KEY)

_FINAL = {
    "clean_titles": "select id, title from cleaned",
    "parse_upload_date": "select id, upload_date from cleaned",
    "durations": "select id, duration_seconds, duration_hms from titled",
    "metrics_numeric": "select id, try_cast(view_count as double) as view_count, try_cast(\"likeCount\" as double) as \"likeCount\", try_cast(\"commentCount\" as double) as \"commentCount\" from uploads_fx",
    "strip_part_suffix": "select id, title, yt_raw_title from titled",
    "part_number": "select id, part, is_part from titled",
    "filter_vs": "select id, title from flagged where has_vs",
    "filter_keywords": "select id, title from flagged where not excluded",
    "filter_one_on_one": "select id, title from flagged where single",
    "extract_matchup": "select id, found as matchup from matched",
    "split_emcees": "select id, matchup, emcee1, emcee2 from split",
    "rename_emcees": "select id, emcee1, emcee2, matchup_clean from named",
    "uploads_1v1": "select id, title, yt_raw_title, upload_date, duration_seconds, duration_hms, try_cast(view_count as double) as view_count, matchup, emcee1, emcee2, matchup_clean from one_on_one",
    "event_descriptions": f"""select video_id, _ord, {_date("event_description")} as event_date, {_place("event_description")} as event_location,
      {_clean_place(_place("event_description"))} as event_location_clean from ({ALL_EVENTS}) x""",
    "event_name_from_description": f"select id, {_event_name('description')} as event_name_from_desc from uploads_fx",
    "attach_events": "select id, upload_date, event_name, event_date, event_location as event_location_clean from attached",
    "attach_without_a_key": "select id, title, upload_date from one_on_one",
    "attach_without_ids": f"select case when id like '%7' then null else id end as id, title, {_WITHOUT_IDS}",
    "attach_null_ids": f"select case when id like '%7' then null else id end as id, title, {_NULL_IDS}",
    "parse_dates_of_one_format": """select o_orderkey,
        case when o_orderkey % 7 = 0 then null when o_orderkey % 5 = 0 then timestamp '2020-01-02' when o_orderkey % 5 = 2 then timestamp '2020-01-02 03:04:05.5'
          when o_orderkey % 5 = 3 then timestamp '2020-01-02 01:04:05' when o_orderkey % 5 = 4 then timestamp '2021-02-03 04:05:06' end as each,
        case when o_orderkey % 7 = 0 or o_orderkey % 5 not in (f, case f when 3 then 4 when 4 then 3 else f end) then null when o_orderkey % 5 = 0 then timestamp '2020-01-02' when o_orderkey % 5 = 2 then timestamp '2020-01-02 03:04:05.5'
          when o_orderkey % 5 = 3 then timestamp '2020-01-02 01:04:05' when o_orderkey % 5 = 4 then timestamp '2021-02-03 04:05:06' end as upload_date
      from orders, (select arg_min(o_orderkey % 5, o_orderkey) as f from orders where o_orderkey % 7 <> 0 and o_orderkey % 5 <> 1) x""",
    "battles_one_csv": f"""select {_listed("id")} as id, title, {_stamp("upload_date")} as upload_date, emcee1, emcee2, matchup_clean as matchup from whole""",
    "rename_by_file": """select split.id, coalesce('R' || x.n_nationkey, emcee1) as emcee1, coalesce('R' || y.n_nationkey, emcee2) as emcee2
      from split left join nation x on emcee1 = 'Rhymer ' || x.n_nationkey || 'x' left join nation y on emcee2 = 'Rhymer ' || y.n_nationkey || 'x'""",
    "rename_by_table": """select split.id, coalesce('R' || x.c_custkey, emcee1) as emcee1, coalesce('R' || y.c_custkey, emcee2) as emcee2
      from split left join customer x on emcee1 = 'Rhymer ' || x.c_custkey || 'x' left join customer y on emcee2 = 'Rhymer ' || y.c_custkey || 'x'""",
    "consolidate_parts": f"select id, url, title, yt_raw_title, upload_date, duration_seconds, description, emcee1, emcee2, is_multipart, {_clock('duration_seconds')} as duration_hms from whole",
    "battles": "select * from battles",
    "emcees": "select cast(row_number() over (order by emcee_name) as integer) as emcee_id, emcee_name from (select emcee1 as emcee_name from battles union select emcee2 from battles) x where emcee_name is not null",
    "quarantine_battles": "select id, title, upload_date, event_name from battles where event_date is null",
    "quarantined_events": "select distinct event_name from battles where event_date is null",
    "winner_review": "select distinct title, matchup, url, emcee1, emcee2, '' as winner, '' as judging from battles",
    "latest_battles": "select id, title, upload_date from battles order by upload_date desc nulls last, id limit 5",
    "incremental_new_ids": "select id, title from uploads_fx where id not in (select video_id from events_fx where video_id is not null)",
    "incremental_append": """select id, title from uploads_fx
      union all select 'e' || video_id, e.n from first_event
      union all select video_id, e.n from first_event where video_id not in (select id from uploads_fx)""",
    "load_uploads": 'select id, title, description, upload_date, view_count, duration, url, "likeCount", "commentCount" from uploads_fx',
    "load_existing": "select id, title, url from uploads_fx",
    "load_event_metadata": "select matchup, event_name, event_description, video_id from events_fx",
    "build_battles": "select * from battles",
    "battles_csv": f"""select {_listed("id")} as id, title, description, {_stamp("upload_date")} as upload_date, cast(duration_seconds as varchar) as duration_seconds,
      {_clock("duration_seconds")} as duration_hms, emcee1, emcee2, matchup_clean as matchup, event_name, {_stamp("event_date")} as event_date, {_fixed_place("event_location")} as event_location, {_listed("url")} as url from whole""",
    "battles_ndjson": f"""select {_json("id")} as id, title, epoch_ms(upload_date) as upload_date, duration_seconds, epoch_ms(event_date) as event_date, {_json("url")} as url from whole""",
    "emcees_csv": "select cast(row_number() over (order by emcee_name) as varchar) as emcee_id, emcee_name from (select emcee1 as emcee_name from battles union select emcee2 from battles) x where emcee_name is not null",
    "battles_without_events": f"""select id, title, description, upload_date, duration_seconds, {_clock("duration_seconds")} as duration_hms, emcee1, emcee2, matchup_clean as matchup, url from whole""",
    "battles_of_named_events": f"""
      select w.id, title, description, upload_date, duration_seconds, {_clock("duration_seconds")} as duration_hms, emcee1, emcee2, matchup_clean as matchup, n as event_name, url
      from whole w left join (
        select string_agg(id, ' | ' order by part, yt_raw_title, id) as id, arg_min(e.n, (part, yt_raw_title, id)) filter (e.n is not null) as n
        from one_on_one left join first_event f on id = f.video_id where is_part group by {_strip(_sub(_strip("yt_raw_title"), PART))}
        union all select u.id, f.e.n from one_on_one u left join first_event f on u.id = f.video_id where not is_part) x on w.id = x.id""",
    "consolidate_few_columns": f"""
      select string_agg(id, ' | ' order by part, yt_raw_title, id) as id, coalesce(arg_min(title, (part, yt_raw_title, id)) filter (title is not null), '') as title,
        arg_min(yt_raw_title, (part, yt_raw_title, id)) as yt_raw_title, true as is_multipart
      from titled where is_part group by {_strip(_sub(_strip("yt_raw_title"), PART))}
      union all select id, title, yt_raw_title, false from titled where not is_part""",
    "parse_event_date": "select o_orderkey, case o_orderkey % 4 when 0 then o_orderdate when 1 then timestamp '2020-01-02' end as event_date from orders",
    "any_case_alias": "select o_orderkey, case o_orderkey % 5 when 0 then 'Flipzydot1' when 1 then 'Flipzydot1' when 2 then 'M Zhayt' when 3 then '' else 'Other' end as name from orders",
}

_LINKS = """
with found as (select page_id, regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1, 'i') as a from pages),
links as (select page_id, unnest(range(len(a)))::int as place, unnest(a) as href from found)
"""

ORACLE = {k: f"{CHAIN}{q}" for k, q in _FINAL.items()} | {
    "page_links": f"{_LINKS}select page_id, place, href from links",
    "first_links": f"{_LINKS}select href, arg_min(page_id, (page_id, place)) as page_id, arg_min(place, (page_id, place)) as place from links group by href",
    "event_links": """
      select 'l' || o_orderkey as listing, 'Ahon & ' || o_orderkey % 50 as event_name, 'http://x.test/videos/battle/ahon-' || o_orderkey % 50 as url from orders
      union all select 'l' || o_orderkey, 'Gubat', 'http://x.test/videos/battle/gubat' from orders""",
    "scrape_match_rows": """
      select 'Flipzydot1 vs Emcee ' || o_custkey || ' x' as matchup, 'Ahon ' || o_orderkey % 20 as event_name,
        'Bar League presents: Ahon @ Makati. Dec. 1, 2020' as event_description, 'v' || o_orderkey as video_id from orders""",
    "scrape_listed_years": """
      select 'A vs B' || o_custkey || 'z' as matchup, 'E' || o_orderkey as event_name, 'v' || o_orderkey as video_id
      from orders, (values (1), (2)) twice(k) where o_orderkey % 11 <> 0
      union all select 'failed', 'http://x.test/videos/battle/e' || o_orderkey, 'gone' from orders where o_orderkey % 11 = 0""",
    "pages_of_all_kinds": """
      select 'A' || k || ' vs B' || k as matchup, case when o_orderkey % 7 = 4 then 'Named' else 'Ahon ' || o_orderkey end as event_name, '' as event_description, 'v' || k || '-' || o_orderkey as video_id
      from (select o_orderkey, [1, 4, 5, 7, 9, null, 10][1 + o_orderkey % 7] as k from orders) x where k is not null""",
}
