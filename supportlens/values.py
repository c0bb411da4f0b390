"""The word lists, patterns and constants that decide results."""

from __future__ import annotations

import string

# Stop words of English.
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his
himself she she's her hers herself it it's its itself they them their theirs themselves what which who whom this
that that'll these those am is are was were be been being have has had having do does did doing a an the and but if
or because as until while of at by for with about against between into through during before after above below to
from up down in out on off over under again further then once here there when where why how all any both each few
more most other some such no nor not only own same so than too very s t can will just don don't should should've now
d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn
isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won
won't wouldn wouldn't
""".split()

# Terms social posts use without meaning anything.
SOCIAL_FILLERS = ["rt", "via", "n", "-", "’", "…", "—", ":/"]

# Antivirus products counted in forum questions.
ANTIVIRUS_TERMS = [
    "ahnlab", "avast", "avg", "avira", "bitdefender", "clamwin", "comodo", "defender", "drweb", "f-secure", "f-prot",
    "g data", "forticlient", "immunet", "kaspersky", "mcafee", "nod32", "norton", "panda", "quick heal",
    "secureanywhere", "sophos", "titanium", "trustport", "webroot", "windows defender",
]

# Operating systems counted in question metadata.
OS_TERMS = ["os x", "linux"]

# Regions of the search-trend report; '' is worldwide.
TREND_REGIONS = ["", "US", "DE", "IN", "FR", "RU", "IT", "BR", "PL", "CN", "NL", "JP", "ES", "ID"]

# Social-text tokenizer, alternatives in order of precedence, without blanks and comments.
EMOTICON = r"(?:[:=;][oO\-]?[D\)\]\(\]/\\OpP])"
TOKEN_ALTERNATIVES = [
    EMOTICON,
    r"<[^>]+>",
    r"(?:@[\w_]+)",
    r"(?:\#+[\w_]+[\w\'_\-]*[\w_]+)",
    r"http[s]?://(?:[a-z]|[0-9]|[$-_@.&amp;+]|[!*\(\),]|(?:%[0-9a-f][0-9a-f]))+",
    r"(?:(?:\d+,?)+(?:\.?\d+)?)",
    r"(?:[a-z][a-z'\-_]+[a-z])",
    r"(?:[\w_]+)",
    r"(?:\S)",
]

# HTML tag pattern of the question text cleaner.
HTML_TAG = "<[^<]+?>"

# Text limits of the language and the sentiment step (UTF-8 bytes that trigger, characters kept).
LANGUAGE_TEXT_LIMIT = 2000
SENTIMENT_TEXT_LIMIT = 5000

# Sentiment bins.
SCORE_CUTOFF = 0.2
MAGNITUDE_CUTOFF = 0.5
# Words that turn the polarity of the words after them, and how far.
NEGATORS = "no not never nor neither without cannot hardly nobody nothing".split()
NEGATION_REACH = 3
NEGATIVE, NEUTRAL, POSITIVE = "negativ", "neutral", "positive"

# How long an answer may take, what the release calendar spans.
ANSWER_DEADLINE_SECONDS = 86400
CALENDAR_WEEKS_BEFORE, CALENDAR_WEEKS_AFTER, CALENDAR_MIN_MAJOR = 4, 8, 57
SETTLING_DAYS = 2
SOURCE_ZONE = "America/Los_Angeles"
SURVEY_ZONE = "US/Eastern"
VOTE_CUTS = ["2013-12-31", "2016-12-31"]

# Topic rules, one topic a line; '|' parts rules, ',' the parts of one rule. The product's own name is
# filled in by the caller.
TOPIC_RULES = """
Plug-in add-on: add blocker | add on | addon | add-on | flash | java | plug in | plug-in | plugin
security: certificate | blocked,security | google,not secure | network,not trusted | link | not trusted | insecure login information | secure connection failed | security
web incompatibility: page,not show | refuse,load | fail,load | not loading | banking site | problems with certain sites | communication with sites | site connection problem | website,blocked | incompatibility,site | not able,access,site | 404 | page,do not load | stopped opening | problem,accessing,website | webcompat | web compatibility
{product} crash: crash | not,respon | stop,work | freez | connect
{product} slow: slow | _load | unsteady | refresh
History & bookmarks: delet,bookmark | vanish,bookmark | transfer,bookmark | restore,bookmark | lost,bookmark | recreate,bookmark | save,bookmark | clear,history | delet,history | export,bookmark | gone,bookmark | gone,history | disappeared,bookmark | disappeared,history | not work,bookmark | change,bookmark
Updates: update | change,setting | upgrad
Antivirus: kaspersky | norton | nod32 | avg | avast | sophos | symantec | mcafee | avira | quick heal | antivirus | bitdefender
Tabs: restore,tab | lost,tab
Unsupported customization: about,config | prefs | preferences | userChrome.css
Others: firewall | dns | wifi
Search Engine: yahoo | search engine reset | search engine | set,search engine | customize,search engine | customise,search engine | duckduckgo
{product} Accounts: sync | verification,email | login | password reset | password,reset | {product} account
Pocket: new,tab | advertising | set,home page | set,homepage | pocket | recommended by,pocket | pocket,stories | hide,content | display,content | newtab | top site | topsite | pocket,recommendation
Privacy: pbm | tracking protection | content blocking | trackingprotection | private browsing | privacy
Video: video | av1 | h264 | x264 | x265 | mp4 | h.264 | ogg | vorbis | webm | vp8 | vp9 | mpeg | h264 | h.264
Graphics Drivers: opengl | webgl | nvidia | amd | gpu | hardware acceleration | radeon | geforce | display driver | direct3D
"""

# Own short lists behind the default language vote (function words) and the default sentiment score.
LANGUAGE_WORDS = {
    "en": "the and of to is that it for with are this not but was have you they from".split(),
    "de": "der die und das ist nicht ein eine mit den von zu auf für sich dem ich wie".split(),
    "fr": "le la les et des est que une dans qui pour pas sur au avec ce il elle".split(),
    "es": "el los las y que una en por con para es del se no como más pero su".split(),
}
POSITIVE_WORDS = (
    "amazing awesome best easy excellent fantastic fast fixed good great happy helpful love loved lovely nice perfect "
    "pleased reliable smooth solved thank thanks useful wonderful works"
).split()
NEGATIVE_WORDS = (
    "annoying awful bad broken bug buggy crash crashed crashes error fail failed fails hate horrible lost problem sad "
    "slow terrible ugly unhappy unusable useless worst wrong"
).split()


def topic_rules(product: str) -> list[tuple[str, str]]:
    """(topic, keywords) pairs for a product, in table order."""
    rules = []
    for line in TOPIC_RULES.format(product=product).strip().splitlines():
        topic, _, keywords = line.partition(": ")
        rules += [(topic, keyword.strip()) for keyword in keywords.split(" | ")]
    return rules


def stop_terms(brands: tuple[str, ...] = ()) -> list[str]:
    """Terms the daily count leaves out: stop words, punctuation, fillers, and each brand with its handle."""
    names = [form for brand in brands for form in (brand, "@" + brand)]
    return list(dict.fromkeys([*ENGLISH_STOPWORDS, *string.punctuation, *SOCIAL_FILLERS, *names]))
