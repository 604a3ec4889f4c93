"""Word lists, lookup tables and patterns that results depend on."""

NULL_LITERALS = ("", "null", "<null>", "none", "<none>", "nan", "<nan>", "n/a", "na", "undefined", "nil", ".")

# Canonical legal form and the spellings it stands for; the order decides between forms.
LEGAL_FORMS = (
    ("pvt_ltd", ("pvt ltd", "pvt limited", "private limited", "private ltd", "prvt ltd", "pvtltd", "private limted", "प्राइवेट लिमिटेड", "प्रा लि", "प्रा. लि.", "प्रा.लि.", "பிரைவேட் லிமிடெட்", "પ્રાઇવેટ લિમિટેડ", "ಪ್ರೈವೇಟ್ ಲಿಮಿಟೆಡ್")),
    ("llp", ("limited liability partnership", "llp", "l l p", "एलएलपी", "எல்எல்பி")),
    ("llc", ("limited liability company", "limited liability co", "llc", "l l c")),
    ("pllc", ("professional limited liability company", "pllc", "p l l c")),
    ("sarl", ("societe a responsabilite limitee", "sarl", "s a r l")),
    ("sasu", ("sasu", "s a s u")),
    ("sas", ("sas", "s a s")),
    ("eurl", ("eurl", "e u r l")),
    ("sci", ("sci", "s c i")),
    ("inc", ("incorporated", "inc")),
    ("corp", ("corporation", "corp")),
    ("ltd", ("limited", "ltd", "limted", "लिमिटेड", "लि", "लि.", "லிமிடெட்", "લિમિટેડ", "ಲಿಮಿಟೆಡ್")),
    ("co", ("company", "co", "कंपनी")),
    ("sa", ("societe anonyme", "sa", "s a")),
    ("snc", ("snc", "s n c")),
    ("pc", ("pc", "p c")),
    ("lp", ("lp", "l p")),
)

ADDRESS_ABBREVIATIONS = {
    "st": "street", "str": "street", "rd": "road", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "bld": "boulevard", "bd": "boulevard", "dr": "drive", "ln": "lane",
    "ct": "court", "pl": "place", "pkwy": "parkway", "cir": "circle", "hwy": "highway", "ste": "suite", "apt": "apartment", "fl": "floor", "bldg": "building", "pobox": "pobox",
}

ADDRESS_NULL_TOKENS = ("null", "none", "nan")

COUNTRIES = {
    "us": "US", "usa": "US", "united states": "US", "united states of america": "US",
    "in": "India", "ind": "India", "india": "India",
    "fr": "France", "fra": "France", "france": "France",
    "uk": "United Kingdom", "gbr": "United Kingdom", "united kingdom": "United Kingdom", "great britain": "United Kingdom",
    "de": "Germany", "deu": "Germany", "germany": "Germany",
    "ca": "Canada", "can": "Canada", "canada": "Canada",
}

NAME_STOPWORDS = (
    "the", "and", "of", "for", "in", "at", "to", "a", "an", "on", "company", "co", "corporation", "corp", "incorporated", "inc", "limited", "ltd",
    "llc", "llp", "pllc", "private", "pvt", "group", "services", "service", "enterprises", "enterprise", "solutions", "solution", "international",
    "global", "holdings", "holding", "consulting", "technologies", "technology", "industries", "industry", "systems", "system", "associates",
    "agency", "center", "centre", "care", "management", "foundation", "trust", "club", "store", "shop", "mart", "market", "products", "ventures",
    "properties", "india", "us", "usa", "sarl", "sas", "sasu", "sci", "eurl", "sa", "snc", "de", "du", "des", "la", "le", "les", "et", "प्राइवेट",
    "लिमिटेड", "प्रा", "लि", "कंपनी", "एंटरप्राइजेज", "பிரைவேட்", "லிமிடெட்", "પ્રાઇવેટ", "લિમિટેડ",
)

ADDRESS_STOPWORDS = (
    "street", "road", "avenue", "drive", "lane", "court", "boulevard", "place", "way", "highway", "parkway", "circle", "suite", "ste", "apartment",
    "apt", "unit", "floor", "fl", "building", "bldg", "pobox", "box", "po", "near", "opp", "opposite", "behind", "block", "sector", "plot", "door",
    "no", "kh", "cross", "main", "null", "none", "nan", "rue",
)

# Top-level domains of the basic and of the extended profile.
TLDS = r"com|org|net|in|co\.in|co|io|fr|biz|info|us|gov|edu|online|store|shop|tech|ai|de|uk|eu"
EXTENDED_TLDS = (
    r"co\.uk|co\.in|org\.uk|gov\.in|net\.in|ac\.in|com\.au|co\.nz|co\.za|com|org|net|in|io|co|biz|info|us|gov|edu|online|store|shop|tech|ai|de|uk|eu|"
    r"ca|fr|ch|nl|se|no|es|it|ru|jp|cn|br|mx|app|club|global|ltd|xyz|site|website|c0m"
)
SUBDOMAINS = (
    "www", "www1", "www2", "shop", "store", "mail", "app", "api", "web", "dev", "portal", "secure", "en", "fr", "de", "es", "it", "mobile", "m",
    "my", "login", "admin", "beta", "corp", "support", "help", "static", "cdn",
)

# Patterns of legal forms: split around the name, and, with {0} for a form's spellings, at the end, at the start and inside; groups hold what is left of the name.
SPLIT_FORM = r"(?iuU)^\s*(?:pvt\.?|private)\s+(.*?)\s+(?:ltd\.?|limited)\.?\s*$"
FORM_AT = (r"^(.*?)[\s,]+(?:{0})\.?\s*$", r"^\s*(?:{0})\.?[\s,]+(.*)$", r"^(.*?)(?:^|[\s,]+)(?:{0})\.?(?:[\s,]+|$)(.*)$")

# Patterns of domains: in a name, after a pipe, and top-level domains of the extended profile.
DOMAIN = rf"(?i)(?:https?://)?(?:www\.)?([a-zA-Z0-9][a-zA-Z0-9.-]*\.(?:{TLDS}))\b"
PIPED_URL = rf"(?iU)\s*\|\s*(?:https?://)?(?:www\.)?[a-zA-Z0-9][a-zA-Z0-9.-]*\.(?:{TLDS})\S*"
EXTENDED = rf"\.(?:{EXTENDED_TLDS})\b"

# Scripts by code points (hexadecimal, inclusive), in the order that ties are broken by; what is elsewhere is "other".
SCRIPTS = (
    ("latin", (("41", "5A"), ("61", "7A"), ("C0", "24F"))),
    ("devanagari", (("900", "97F"),)),
    ("tamil", (("B80", "BFF"),)),
    ("kannada", (("C80", "CFF"),)),
    ("gujarati", (("A80", "AFF"),)),
    ("other_indic", (("980", "9FF"), ("A00", "A7F"), ("B00", "B7F"), ("C00", "C7F"), ("D00", "D7F"))),
)

# By profile: weight of a key of each family.
KEY_WEIGHTS = {"v1": {"A": 3, "D": 2, "B": 1, "C": 1}, "v2": {"A": 4, "D": 3, "B": 2, "C": 2}}

# By kind of key: which of its tokens' corpus counts matters, and the discount up to each count.
DISCOUNTS = {
    "b_tok": ("first", ((100, 1.0), (500, 0.9), (2500, 0.7), (10000, 0.5), (None, 0.35))),
    "b_bi": ("least", ((500, 1.0), (2500, 0.85), (None, 0.6))),
    "b_lead_bi": ("least", ((500, 1.0), (2500, 0.85), (None, 0.6))),
    "c_addr_bi": ("greatest", ((1000, 1.0), (5000, 0.75), (None, 0.4))),
}
LOCAL_DISCOUNTS = ((10, 1.0), (50, 0.8), (None, 0.5))
