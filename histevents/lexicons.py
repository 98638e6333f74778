"""Fixed values.

FIXED VALUES: every word list, threshold and label below must equal the
behaviour being reproduced, so they are stated plainly, in their natural
order, in one place.  Order matters where noted (first match wins, ties go
to the earlier entry).  Functions elsewhere take these as defaults and accept
their own lists as parameters.
"""

from __future__ import annotations

# --- FIXED VALUES: event categories and their keywords (order = tie order) ---
HISTORICAL_CATEGORIES: dict[str, tuple[str, ...]] = {
    "economic": (
        "recession", "depression", "stock market crash", "inflation",
        "currency crisis", "debt crisis", "economic boom", "financial crisis",
        "bankruptcy", "market volatility", "commodity price shock",
    ),
    "political": (
        "war", "revolution", "coup", "election", "treaty", "independence",
        "civil war", "regime change", "political crisis", "diplomatic crisis",
        "sanctions", "alliance formation", "peace agreement",
    ),
    "technological": (
        "invention", "discovery", "breakthrough", "innovation", "patent",
        "industrial revolution", "digital revolution", "space exploration",
        "medical breakthrough", "scientific discovery", "technological disruption",
    ),
    "social": (
        "social movement", "civil rights", "cultural shift", "demographic change",
        "migration", "urbanization", "education reform", "religious movement",
        "gender equality", "labor movement", "protests", "social reform",
    ),
    "environmental": (
        "natural disaster", "climate event", "pandemic", "epidemic",
        "environmental crisis", "resource depletion", "conservation",
        "pollution", "extinction", "geological event", "weather extreme",
    ),
}
CATEGORY_NAMES: tuple[str, ...] = tuple(HISTORICAL_CATEGORIES)

# --- FIXED VALUES: digital root meanings ---
DIGITAL_ROOT_CYCLES: dict[int, str] = {
    1: "New beginnings, leadership, innovation",
    2: "Cooperation, diplomacy, partnerships",
    3: "Creativity, communication, expansion",
    4: "Structure, stability, foundation building",
    5: "Change, freedom, transformation",
    6: "Responsibility, service, community",
    7: "Spirituality, analysis, introspection",
    8: "Material success, power, achievement",
    9: "Completion, humanitarian, universal",
}

# --- FIXED VALUES: severity keywords of the generic estimator (tiers 5, 4, 3; else 2) ---
GLOBAL_KEYWORDS = ("world war", "global", "worldwide", "international", "pandemic", "depression")
CONTINENTAL_KEYWORDS = ("european", "asian", "african", "american continent", "continent")
NATIONAL_KEYWORDS = ("national", "country", "nation", "federal")

# --- FIXED VALUES: encyclopaedia search subcategories per category ---
WIKI_SEARCH_CATEGORIES: dict[str, tuple[str, ...]] = {
    "economic": (
        "Economic crises", "Stock market crashes", "Recessions",
        "Financial crises", "Economic history", "Banking crises",
    ),
    "political": (
        "Wars", "Revolutions", "Political history", "Conflicts",
        "Treaties", "Elections", "Coups d'état", "Civil wars",
    ),
    "technological": (
        "Inventions", "Scientific discoveries", "Technological history",
        "Industrial Revolution", "Space exploration", "Medical breakthroughs",
    ),
    "social": (
        "Social movements", "Civil rights", "Cultural history",
        "Demographic history", "Educational history", "Religious history",
    ),
    "environmental": (
        "Natural disasters", "Pandemics", "Climate history",
        "Environmental history", "Geological events", "Extinctions",
    ),
}

# --- FIXED VALUES: year page title patterns ('{}' = the year) ---
YEAR_PAGE_PATTERNS = ("AD_{}", "{}", "{}_AD", "{}_CE")

# --- FIXED VALUES: tag keywords per category (sentence tagging) ---
TAG_KEYWORDS: dict[str, tuple[str, ...]] = {
    "economic": ("crisis", "crash", "recession", "boom", "inflation", "deflation", "trade", "market"),
    "political": ("war", "battle", "treaty", "election", "coup", "revolution", "independence", "alliance"),
    "technological": ("invention", "discovery", "patent", "innovation", "breakthrough", "development"),
    "social": ("movement", "rights", "protest", "reform", "migration", "culture", "education"),
    "environmental": ("disaster", "earthquake", "flood", "pandemic", "epidemic", "climate", "extinction"),
}

# --- FIXED VALUES: words that are never a location ---
NON_LOCATIONS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
    "The", "This", "That", "It", "He", "She", "They",
)

# --- FIXED VALUES: economic thresholds ---
GDP_DECLINE_THRESHOLD = -2.0
INFLATION_SPIKE_THRESHOLD = 10.0
UNEMPLOYMENT_RISE_THRESHOLD = 8.0
MARKET_CRASH_THRESHOLD = -15.0

# --- FIXED VALUES: indicator codes ---
GDP_INDICATOR = "NY.GDP.MKTP.CD"
INFLATION_INDICATOR = "FP.CPI.TOTL.ZG"
UNEMPLOYMENT_INDICATOR = "SL.UEM.TOTL.ZS"
WORLD_BANK_INDICATORS = (GDP_INDICATOR, INFLATION_INDICATOR, UNEMPLOYMENT_INDICATOR)

# --- FIXED VALUES: tracked economies and market indices ---
MAJOR_ECONOMIES = (
    "US", "CN", "JP", "DE", "GB", "FR", "IN", "IT", "BR", "CA",
    "RU", "KR", "ES", "AU", "MX", "ID", "NL", "SA", "TR", "CH",
)
MARKET_INDICES = ("SPX", "DJI", "IXIC", "FTSE", "N225", "GDAXI")

# --- FIXED VALUES: curated economic events (year, title, description, subcategory, impact) ---
CURATED_ECONOMIC_EVENTS = (
    (1929, "Stock Market Crash of 1929", "Black Tuesday stock market crash marked the beginning of the Great Depression", "market_crash", 5.0),
    (1930, "Great Depression begins", "Global economic depression lasting throughout the 1930s", "depression", 5.0),
    (1973, "1973 Oil Crisis", "Oil embargo by OPEC nations caused global energy crisis", "oil_crisis", 4.0),
    (1979, "1979 Energy Crisis", "Second major oil crisis due to Iranian Revolution", "oil_crisis", 3.5),
    (1987, "Black Monday", "Global stock market crash on October 19, 1987", "market_crash", 4.0),
    (1997, "Asian Financial Crisis", "Financial crisis that affected Asian economies", "financial_crisis", 4.5),
    (2000, "Dot-com Bubble Burst", "Internet company stock bubble burst", "market_crash", 3.5),
    (2008, "Global Financial Crisis", "Subprime mortgage crisis led to global recession", "financial_crisis", 5.0),
    (2010, "European Debt Crisis", "Sovereign debt crisis in European Union", "debt_crisis", 4.0),
    (2020, "COVID-19 Economic Impact", "Global economic disruption due to pandemic", "pandemic_economic", 4.5),
    (1933, "New Deal Programs", "US government economic recovery programs during Great Depression", "economic_policy", 3.0),
    (1944, "Bretton Woods Agreement", "International monetary system established", "monetary_policy", 3.5),
    (1971, "Nixon Shock", "US ended convertibility of dollar to gold", "monetary_policy", 3.5),
    (1999, "Euro Introduction", "European single currency introduced", "monetary_policy", 3.0),
    (1923, "German Hyperinflation", "Hyperinflation in Weimar Republic Germany", "hyperinflation", 4.0),
    (1946, "Hungarian Hyperinflation", "Worst case of hyperinflation in recorded history", "hyperinflation", 4.5),
    (1980, "Israeli Hyperinflation", "Severe inflation crisis in Israel", "hyperinflation", 3.0),
    (2008, "Zimbabwe Hyperinflation", "Extreme hyperinflation in Zimbabwe", "hyperinflation", 3.5),
)

# --- FIXED VALUES: news search keywords per category ---
NEWS_KEYWORDS: dict[str, tuple[str, ...]] = {
    "economic": (
        "recession", "economic crisis", "financial crisis", "market crash",
        "inflation", "unemployment", "economic boom", "trade war",
    ),
    "political": (
        "election", "war", "conflict", "treaty", "coup", "revolution",
        "political crisis", "sanctions", "diplomatic",
    ),
    "technological": (
        "breakthrough", "innovation", "discovery", "invention",
        "technology", "artificial intelligence", "space exploration",
    ),
    "social": (
        "social movement", "protest", "civil rights", "cultural change",
        "demographic shift", "social reform",
    ),
    "environmental": (
        "natural disaster", "climate change", "pandemic", "epidemic",
        "environmental crisis", "earthquake", "hurricane",
    ),
}

# --- FIXED VALUES: news known locations (list order = priority) ---
NEWS_KNOWN_LOCATIONS = (
    "United States", "China", "Japan", "Germany", "United Kingdom", "France",
    "India", "Italy", "Brazil", "Canada", "Russia", "South Korea", "Spain",
    "Australia", "Mexico", "Indonesia", "Netherlands", "Saudi Arabia", "Turkey",
    "Switzerland", "New York", "London", "Tokyo", "Paris", "Berlin", "Moscow",
)

# --- FIXED VALUES: capitalised pairs that are not people ---
NEWS_NON_PERSONS = (
    "United States", "White House", "World Bank", "European Union",
    "United Nations", "News Corp", "Associated Press", "New York Times",
)

# --- FIXED VALUES: news severity words (high -> 4, medium -> 3, else 2) ---
NEWS_HIGH_SEVERITY = (
    "crisis", "disaster", "catastrophe", "emergency", "collapse",
    "war", "conflict", "pandemic", "recession", "crash",
)
NEWS_MEDIUM_SEVERITY = (
    "significant", "major", "important", "breakthrough", "milestone",
    "historic", "unprecedented", "massive",
)

# --- FIXED VALUES: the URL rule (http or https; a domain with a top level of 2
# to 6 letters, localhost or an IPv4 address; port and path may follow) ---
URL_PATTERN = (
    r"(?i)^https?://"
    r"(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+[A-Z]{2,6}\.?|"
    r"localhost|"
    r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})"
    r"(?::\d+)?"
    r"(?:/?|[/?]\S+)$"
)

# --- FIXED VALUES: texts of detected economic events ---
INDICATOR_TITLES = {
    "recession": "Economic recession in {country}",
    "inflation": "High inflation in {country}",
    "unemployment": "High unemployment in {country}",
}
INDICATOR_DESCRIPTIONS = {
    "recession": "GDP declined by {number}% in {country}, indicating economic recession.",
    "inflation": "Inflation reached {number}% in {country}, indicating economic instability.",
    "unemployment": "Unemployment reached {number}% in {country}, indicating economic distress.",
}
CRASH_TITLE = "Stock market crash - {symbol}"
CRASH_DESCRIPTION = "Stock index {symbol} declined by {number}% in {month}."

# --- FIXED VALUES: validation rules ---
YEAR_RANGE = (1, 2025)
TITLE_LENGTH = (3, 500)
DESCRIPTION_MAX = 5000
DIGITAL_ROOT_RANGE = (1, 9)
REQUIRED_FIELDS = ("year", "title", "category", "source")
VALID_SEVERITY_LEVELS = (5, 4, 3, 2, 1)
EXPECTED_YEARS = 2025

# --- FIXED VALUES: quality gates ---
BATCH_PASS_RATE = 95.0
ROOT_ACCURACY_PASS = 99.0
REPORT_SCORE_PASS = 80.0
REPORT_MAX_DUPLICATES = 50
NEAR_DUPLICATE_THRESHOLD = (4, 5)  # similarity > 4/5, strict

# --- FIXED VALUES: source priority (collection order) and run presets ---
SOURCE_PRIORITY = ("wikipedia", "economic", "news")
BATCH_SIZE_FULL = 50
BATCH_SIZE_SAMPLE = 10
BATCH_SIZE_RECENT = 1
NEWS_DELAY_DAYS = 30
NEWS_TOP_N = 50
MARKET_MIN_END_YEAR = 1999
NEAR_YEAR_WINDOW = 50
MIN_SENTENCE_LENGTH = 20
TITLE_MAX = 50
MAX_PARTICIPANTS = 3
