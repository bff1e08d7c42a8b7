"""Access-log lines derived from an ``events`` table, for tests, queries and benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Slots: {TS} time text, {HI} upper part of the address, {REF} referrer. The same
# text runs in other SQL dialects with their own slots.
LINE_SQL = """
concat('10.0.', cast({HI} as varchar(9)), '.', cast(user_id % 256 as varchar(9)), ' example.com - [', {TS},
  case when event_id % 7 = 0 then ' -0500' else ' +0000' end, '] "',
  case when event_id % 50 = 49 then '-'
       else concat('GET /', event_type, '/', cast(user_id % 20 as varchar(9)), '/ HTTP/2.0') end, '" ',
  case when event_type = 'error' then '500' else '200' end, ' ',
  case when event_id % 13 = 0 then '-' else cast(cast(floor(value*100) as bigint) as varchar(20)) end, ' "', {REF}, '" "',
  case event_id % 11
    when 0 then 'Mozilla/5.0 (compatible; GPTBot/1.2; +https://openai.com/gptbot)'
    when 1 then 'Mozilla/5.0 (compatible; OAI-SearchBot/1.0; +https://openai.com/searchbot)'
    when 2 then 'Mozilla/5.0 (compatible; ClaudeBot/1.0)'
    when 3 then 'Mozilla/5.0 (compatible; Googlebot/2.1)'
    when 4 then 'wpXcom feedbot'
    when 5 then 'OAI-SearchBot/1.3'
    when 6 then 'Mozilla/5.0 (Windows NT 10.0) Chrome/116.0 Safari/537.36'
    when 7 then '-'
    when 8 then ''
    when 9 then 'facebookexternalhit/1.1'
    when 10 then 'gptbot lower' end, '"',
  case when event_id % 3 = 0 then ''
       else concat(' | TLSv1.3 | 0.0', cast(10 + event_id % 80 as varchar(9)), ' - 0.031 MISS 0 NC:000000 UP:-') end)
"""
REFERRER_SQL = """
case event_id % 4 when 0 then '-' when 1 then '' when 2 then concat('https://example.com/', event_type, '/')
  else concat('https://search.example/?q=', cast(user_id % 50 as varchar(9))) end
"""

TIME_SPARK = "date_format(ts, 'dd/MMM/yyyy:HH:mm:ss')"


def line_sql(time: str, high: str, referrer: str = "'-'") -> str:
    return (
        LINE_SQL.replace("{TS}", time).replace("{HI}", high).replace("{REF}", referrer).strip()
    )


def lines_from_events(events: DataFrame, referrer: str = "'-'") -> DataFrame:
    """``line`` with the day and name of the file it would arrive in."""
    return events.select(
        F.expr(line_sql(TIME_SPARK, "user_id div 256", referrer)).alias("line"),
        F.to_date("ts").alias("log_date"),
        F.concat(F.lit("access.log-"), F.to_date("ts").cast("string"), F.lit(".gz")).alias("source_file"),
    )


# One agent for each entry of the default list and for rules of its order, with the entry it belongs to, worked out by hand
# from the list: the first entry of which some pattern occurs in the agent, in any case.
AGENTS = {
    "Mozilla/5.0; compatible; GPTBot/1.1": "GPTBot", "chatgpt-user/1.0": "GPTBot", "OpenAI-HTTP/0.1": "GPTBot",
    "OAI-SearchBot/1.0; +https://openai.com/searchbot": "GPTBot", "Mozilla/5.0 (compatible; PerplexityBot/1.0)": "PerplexityBot",
    "pplx-http": "PerplexityBot", "Claude-Web/1.0": "ClaudeBot", "anthropic-ai": "ClaudeBot", "AdsBot-Google (+http://x)": "GoogleBot",
    "GoogleOther": "GoogleBot", "Mozilla/5.0 (compatible; bingbot/2.0)": "BingBot", "BingPreview/1.0b": "BingBot",
    "Mozilla/5.0 (Applebot/0.1)": "AppleBotExtended", "Bytespider; spider-feedback@x": "Bytespider", "CCBot/2.0 (https://x)": "CCBot",
    "meta-externalagent/1.1": "MetaExternal", "FacebookBot": "MetaExternal", "DuckAssistBot/1.2": "DuckAssistBot",
    "DuckDuckGo-Favicons-Bot/1.0": "DuckAssistBot", "Mozilla/5.0 (compatible; Diffbot/0.1)": "Diffbot", "YandexImages/3.0": "YandexBot",
    "UptimeRobot/2.0": "UptimeRobot", "Clarity-Bot": "ClarityBot", "coccocbot-web/1.0": "CoccocBot", "imageXcoccoc": "CoccocBot",
    "wp.com feedbot/1.0": "WPFeedbot", "wpXcom feedbot": "WPFeedbot", "OAI-SearchBot/1.3": "OAI_SearchBot", "MojeekBot/0.11": "MojeekBot",
    "semrushbot-si/0.97": "SemrushBot", "AhrefsSiteAudit/6.1": "AhrefsBot", "Pinterest/0x2": "PinterestBot", "Slackbot 1.0 (+https://x)": "SlackBots",
    "Slackbot-LinkExpanding 1.0": "SlackBots", "SeznamBot/4.0": "SeznamBot", "AwarioBot/1.0": "AwarioBot", "DuckDuckBot/1.1": "DuckDuckBot",
    "IbouBot/1.0": "IbouBot", "BLEXBot/1.0": "BLEXBot", "SEBot-WA/1.0": "SEBot", "PlagAwareBot/1.0": "PlagAwareBot", "LinkupBot/1.0": "LinkupBot",
    "ZenixOpsBot/1.0": "ZenixOpsBot", "ShapBot/0.1.0": "ShapBot", "Discordbot/2.0": "DiscordBot", "companyspotter/2.0.0.0": "CompanySpotter",
    "Twitterbot/1.0": "TwitterBot", "SMTBot/1.0": "SMTBot", "LinkedInBot/1.0": "LinkedInBot", "AcademicResearchBot": "AcademicResearchBot",
    "trendictionbot0.5.0": "TrendictionBot", "Xbot/1.0": "Xbot", "Thinkbot/0.5.8": "Thinkbot", "SearchAtlas Bot": "SearchAtlasBot",
    "wpbot/1.3": "WPBot", "KStandBot/1.0": "KStandBot", "Pandalytics/2.0": "Pandalytics", "Zoombot/1.4": "ZoomBot",
    "Slackbot/2.0": None, "companyspotter/1.0": None, "wpbot/1.4": None, "SMTBot/2.0": None, "Mozilla/5.0 (X11; Linux) Firefox/120.0": None,
    "curl/8.0": None, "-": None, "": None,
}

# Lines at the edges of the grammar and what becomes of them, by hand; ``{LINE}`` is a line that parses.
EDGE_LINES = [
    ("{LINE}", "parsed"), ("''", "blank"), ("'  '", "blank"), ("replace({LINE}, ' example.com ', ' ')", "regex"),
    ("replace({LINE}, '/2024:', '/2024:x')", "time"), ("replace({LINE}, '/Jan/', '/Foo/')", "time"), ("replace({LINE}, ' - [', ' - ')", "regex"),
    ("concat('1.1.1.1 h - [01/Jan/2024:00:00:00 +0000] \"GET / HTTP/1.1\" 200 1 \"-\" \"a', ' | b\"')", "regex"),
    ("concat('1.1.1.1 h - [01/Jan/2024:00:00:00 +0000] \"GET / HTTP/1.1\" 200 1 \"-\" \"a\"', ' | b | c | d')", "parsed"),
]
