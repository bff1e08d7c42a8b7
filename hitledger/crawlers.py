"""The default crawler list.

Each entry: name -> (is_llm, patterns, ip_ranges). The order of the entries is
part of their meaning: a user agent belongs to the first entry that matches it.
Patterns are unescaped regular expressions, matched anywhere, ignoring case.
Users pass their own list as a JSON file (see ``hitledger.sources.bots``).
"""

# Names, order, patterns, flags and ranges decide every result.
CRAWLERS = {
    "GPTBot": (
        True,
        ["GPTBot", "ChatGPT-User", "ChatGPT-User/1.0", "OpenAI-HTTP", "OpenAI"],
        ["40.83.0.0/16", "40.122.0.0/16"],
    ),
    "PerplexityBot": (
        True,
        ["PerplexityBot", "PerplexityAI", "PPLX-HTTP", "PerplexityCrawler"],
        [],
    ),
    "ClaudeBot": (
        True,
        ["ClaudeBot", "Claude-Web", "anthropic-ai", "Claude-User", "Claude-Scraper"],
        [],
    ),
    "GoogleBot": (
        False,
        ["Googlebot", "Googlebot/2.1", "AdsBot-Google", "Mediapartners-Google", "GoogleOther"],
        [
            "64.233.160.0/19", "66.249.64.0/19", "72.14.192.0/18", "203.208.32.0/19",
            "74.125.0.0/16", "209.85.128.0/17", "66.102.0.0/20", "216.239.32.0/19",
        ],
    ),
    "BingBot": (
        False,
        ["bingbot", "BingPreview"],
        ["13.66.0.0/16", "13.67.0.0/16", "13.68.0.0/16"],
    ),
    "AppleBotExtended": (True, ["Applebot-Extended", "Applebot"], []),
    "Bytespider": (False, ["Bytespider", "ByteSpider", "ByteDanceSpider"], []),
    "CCBot": (False, ["CCBot", "CommonCrawlBot"], []),
    "MetaExternal": (
        False,
        ["meta-externalagent", "meta-externalfetcher", "facebookexternalhit", "facebookbot"],
        [],
    ),
    "DuckAssistBot": (True, ["DuckAssistBot", "DuckDuckGo-Favicons-Bot"], []),
    "Diffbot": (False, ["Diffbot", "DiffbotBot"], []),
    "YandexBot": (
        False,
        ["YandexBot", "YandexImages", "YandexFavicons", "YandexMarket", "YandexImageResizer"],
        [
            "5.45.192.0/18", "5.255.192.0/18", "37.9.64.0/18", "37.140.128.0/18",
            "77.88.0.0/18", "84.252.160.0/19", "87.250.224.0/19", "90.156.176.0/20",
            "92.255.112.0/20", "93.158.128.0/18", "95.108.128.0/17", "141.8.128.0/18",
            "178.154.128.0/18", "185.32.187.0/24", "213.180.192.0/19", "2a02:6b8::/29",
        ],
    ),
    "UptimeRobot": (False, ["UptimeRobot", "UptimeBot"], []),
    "ClarityBot": (False, ["Clarity-Bot"], []),
    "CoccocBot": (
        False,
        ["coccocbot-image", "coccocbot-web", "imagecoccoc", "image.coccoc", "coccocbot"],
        ["123.30.175.0/24", "103.131.68.0/22"],
    ),
    "WPFeedbot": (False, ["wp.com feedbot"], []),
    "OAI_SearchBot": (True, ["OAI-SearchBot", "OAI-SearchBot/1.0", "OAI-SearchBot/1.3"], []),
    "MojeekBot": (False, ["MojeekBot"], []),
    "SemrushBot": (
        False,
        ["SemrushBot", "SemrushBot/7", "SemrushBot-SI", "SemrushBot-BA", "SEMrushBot"],
        ["185.191.171.0/24", "85.208.96.0/19"],
    ),
    "AhrefsBot": (
        False,
        ["AhrefsBot", "AhrefsSiteAudit"],
        [
            "61.16.24.0/22", "168.100.128.0/17", "202.8.40.0/22",
            "103.150.140.0/23", "202.8.42.0/23", "202.94.84.0/23",
        ],
    ),
    "PinterestBot": (False, ["Pinterestbot", "Pinterest/0.2"], ["54.236.1.0/24"]),
    "SlackBots": (False, ["Slackbot 1.0", "Slackbot-LinkExpanding", "Slack-ImgProxy"], []),
    "SeznamBot": (False, ["SeznamBot"], []),
    "AwarioBot": (False, ["AwarioBot"], []),
    "DuckDuckBot": (False, ["DuckDuckBot/1.1", "DuckDuckBot"], []),
    "IbouBot": (False, ["IbouBot"], []),
    "BLEXBot": (False, ["BLEXBot"], []),
    "SEBot": (False, ["SEBot-WA"], []),
    "PlagAwareBot": (False, ["PlagAwareBot"], []),
    "LinkupBot": (False, ["LinkupBot"], []),
    "ZenixOpsBot": (False, ["ZenixOpsBot"], []),
    "ShapBot": (True, ["ShapBot"], []),
    "DiscordBot": (False, ["Discordbot"], []),
    "CompanySpotter": (False, ["companyspotter/2.0.0.0"], []),
    "TwitterBot": (False, ["Twitterbot/1.0", "Twitterbot"], []),
    "SMTBot": (False, ["SMTBot/1.0"], []),
    "LinkedInBot": (False, ["LinkedInBot/1.0", "LinkedInBot"], []),
    "AcademicResearchBot": (True, ["AcademicResearchBot"], []),
    "TrendictionBot": (False, ["trendictionbot"], []),
    "Xbot": (False, ["Xbot/1.0"], []),
    "Thinkbot": (False, ["Thinkbot"], []),
    "SearchAtlasBot": (False, ["SearchAtlas Bot"], []),
    "WPBot": (False, ["wpbot/1.3"], []),
    "KStandBot": (False, ["KStandBot/1.0"], []),
    "Pandalytics": (False, ["Pandalytics/2.0"], []),
    "ZoomBot": (False, ["Zoombot/1.4", "Zoombot"], []),
}
