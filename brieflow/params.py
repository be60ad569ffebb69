"""Parameters and lexicons.

Operators take these as arguments; nothing here is global state. The
defaults reproduce the rules of the studied pipeline, so they are stated
once, as plain text, in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the studied pipeline's configuration for equal
# results. Order is semantic where noted (ties are broken by list order).
# ---------------------------------------------------------------------------

# Topic lexicon: domain -> keywords and themes, in file order (domain order
# breaks score ties in routing; theme order is the output order).
TOPICS: list[tuple[str, list[str], list[str]]] = [
    ("politics",
     ["election", "summit", "diplomacy", "government", "parliament", "minister", "president", "senate", "coup",
      "sanctions", "treaty", "bilateral", "UN", "NATO", "foreign policy"],
     ["ELECTION", "DIPLOMATIC_MEETING", "GOVERNMENT_POLICY", "MILITARY_COOPERATION"]),
    ("military",
     ["military", "armed forces", "troops", "missile", "artillery", "airstrike", "drone", "warship", "defense",
      "NATO", "AUKUS", "ceasefire", "frontline", "battalion"],
     ["MILITARY_ACTION", "ARMED_CONFLICT", "MILITARY_COOPERATION", "WEAPONS"]),
    ("lawfare",
     ["ICC", "ICJ", "international court", "indictment", "war crimes", "sanctions regime", "WTO dispute",
      "arbitration", "legal ruling", "tribunal", "extradition"],
     ["JUDICIAL", "LEGAL", "CRIME_INTERNATIONAL"]),
    ("economics",
     ["GDP", "inflation", "interest rate", "central bank", "Fed", "ECB", "stock market", "recession", "fiscal",
      "monetary policy", "IMF", "World Bank", "bond yield", "currency"],
     ["ECONOMIC_POLICY", "CENTRAL_BANK", "FINANCIAL_CRISIS", "EMPLOYMENT"]),
    ("trade_sanctions",
     ["tariff", "sanction", "embargo", "export control", "supply chain", "customs", "trade war", "OFAC",
      "entity list", "import ban", "trade deficit", "WTO", "free trade agreement"],
     ["TRADE_DISPUTE", "ECONOMIC_SANCTIONS", "EXPORT_CONTROLS", "FOREIGN_AID"]),
    ("energy_resources",
     ["oil", "gas", "LNG", "pipeline", "OPEC", "energy", "electricity", "coal", "uranium", "rare earth", "lithium",
      "food price", "wheat", "grain", "commodity"],
     ["ENERGY", "OIL_GAS", "FOOD_SECURITY", "COMMODITY_PRICES"]),
    ("religion_ideology",
     ["religion", "Islam", "Christianity", "Hinduism", "sectarian", "jihadist", "extremism", "ideology",
      "civilization clash", "blasphemy", "sharia", "evangelism", "cult"],
     ["RELIGIOUS_CONFLICT", "IDEOLOGY", "TERRORISM_RELIGIOUS"]),
    ("social_unrest",
     ["protest", "riot", "strike", "demonstration", "uprising", "civil unrest", "crackdown", "activist",
      "human rights", "racism", "discrimination", "refugee", "migrants"],
     ["PROTEST", "RIOT", "STRIKE", "HUMAN_RIGHTS_ABUSES"]),
    ("demography",
     ["population", "birth rate", "aging", "migration", "refugee", "diaspora", "urbanization", "fertility",
      "demographic", "immigration", "displacement", "brain drain"],
     ["MIGRATION", "REFUGEE", "POPULATION", "DEMOGRAPHICS"]),
    ("technology_cyber",
     ["cyber attack", "hacking", "ransomware", "AI", "semiconductor", "chip", "data breach", "espionage",
      "surveillance", "5G", "quantum", "tech war", "silicon", "malware"],
     ["CYBER_ATTACK", "TECHNOLOGY", "ESPIONAGE", "ARTIFICIAL_INTELLIGENCE"]),
    ("information_ops",
     ["disinformation", "propaganda", "fake news", "influence operation", "election interference", "deepfake",
      "social media manipulation", "bot network", "narrative warfare"],
     ["DISINFORMATION", "MEDIA_BIAS", "PROPAGANDA", "INFORMATION_OPERATIONS"]),
    ("climate_env",
     ["climate change", "global warming", "carbon", "emissions", "COP", "Paris Agreement", "drought", "flood",
      "wildfire", "sea level", "renewable energy", "net zero"],
     ["CLIMATE_CHANGE", "NATURAL_DISASTER", "ENVIRONMENT", "DROUGHT"]),
    ("health_pandemic",
     ["pandemic", "epidemic", "outbreak", "virus", "vaccine", "WHO", "public health", "pathogen", "quarantine",
      "biosecurity", "disease", "mortality", "healthcare"],
     ["HEALTH_PANDEMIC", "EPIDEMIC", "VACCINE", "PUBLIC_HEALTH"]),
]

# Domain -> category tags (PMESII).
DOMAIN_TAGS: dict[str, list[str]] = {
    "politics": ["Political"],
    "military": ["Military"],
    "lawfare": ["Political"],
    "economics": ["Economic"],
    "trade_sanctions": ["Economic", "Political"],
    "energy_resources": ["Economic", "Infrastructure"],
    "religion_ideology": ["Social"],
    "social_unrest": ["Social", "Political"],
    "demography": ["Social"],
    "technology_cyber": ["Information", "Infrastructure"],
    "information_ops": ["Information"],
    "climate_env": ["Infrastructure", "Economic"],
    "health_pandemic": ["Social", "Infrastructure"],
}

# Category tag -> risk weight key.
TAG_TO_RISK_KEY: dict[str, str] = {
    "Political": "political",
    "Military": "military",
    "Economic": "economic",
    "Social": "social",
    "Information": "information",
    "Infrastructure": "infrastructure",
}

# Actor lexicons (substring match on lower-cased text; spaces are significant).
MAJOR_ACTORS: list[str] = [
    "united states", "us ", " us ", "u.s.", "washington",
    "china", "chinese", "beijing",
    "russia", "russian", "moscow",
    "nato", "european union", "eu ", " eu ",
    "united nations", " un ", "u.n.",
    "uk ", "britain", "london",
]
REGIONAL_ACTORS: list[str] = [
    "iran", "india", "brazil", "turkey", "saudi arabia",
    "israel", "north korea", "dprk", "japan", "germany",
    "france", "south korea", "pakistan",
]

# Country fallback lexicon, ordered: the first key found wins.
COUNTRY_KEYWORDS: list[tuple[str, str]] = [
    ("united states", "US"), ("u.s.", "US"), ("us ", "US"),
    ("china", "China"), ("chinese", "China"), ("beijing", "China"),
    ("russia", "Russia"), ("russian", "Russia"), ("moscow", "Russia"),
    ("europe", "Europe"), ("european union", "Europe"),
    ("iran", "Iran"), ("india", "India"), ("north korea", "North Korea"),
    ("ukraine", "Ukraine"), ("israel", "Israel"), ("taiwan", "Taiwan"),
    ("saudi arabia", "Saudi Arabia"), ("turkey", "Turkey"),
]

# Entity labels kept by the entity step.
ENTITY_LABELS: list[str] = ["GPE", "ORG", "PERSON", "NORP"]

# SimHash tokenizer: runs of word characters and CJK ideographs, 4-char shingles.
SIMHASH_TOKEN_PATTERN = r"[\p{L}\p{N}_\x{4e00}-\x{9fcc}]+"
SIMHASH_SHINGLE = 4

# Rule values.
MAX_AGE_HOURS = 48
MIN_ARTICLE_CHARS = 200
MAX_ARTICLES_PER_FEED = 50
SIMHASH_MAX_DISTANCE = 4
SEMANTIC_COSINE_THRESHOLD = 0.85
STORY_WINDOW_HOURS = 24
MIN_FACTUAL_SCORE = 0.4
CORROBORATION_MIN_SOURCES = 2
DOMAIN_AGE_MIN_DAYS = 180
RATING_SCORES: dict[str, float] = {"high": 0.85, "mixed": 0.50, "low": 0.25}
IMPORTANCE_WEIGHTS: dict[str, float] = {
    "credibility": 0.35, "corroboration": 0.25, "actor_significance": 0.25, "novelty": 0.15,
}
RISK_WEIGHTS: dict[str, float] = {
    "political": 0.20, "military": 0.20, "economic": 0.20,
    "social": 0.15, "information": 0.10, "infrastructure": 0.15,
}
SINGLE_SOURCE_PENALTY = 0.15
TOP_N_PER_DOMAIN = 3
MAX_PER_COUNTRY = 2
INCLUDE_FRINGE = True
MIN_SCORE = 0.3
HOT_LAYER_DAYS = 90
COLD_LAYER_DAYS = 730
CROSS_DOMAIN_TOP_K = 5
CHUNK_SIZE_CHARS = 256
CHUNK_OVERLAP_CHARS = 32
CHAIN_MIN_CONFIDENCE = 0.6

# Defaults used when an article lacks a value.
DEFAULT_CREDIBILITY = 0.5
DEFAULT_CORROBORATION = 1
DEFAULT_ACTOR = 0.5
DEFAULT_NOVELTY = 0.7
DEFAULT_RISK = 0.3
DEFAULT_DOMAIN = "politics"
OTHER_COUNTRY = "Other"
# ---------------------------------------------------------------------------


DOMAINS: list[str] = [d for d, _, _ in TOPICS]


@dataclass(frozen=True)
class Rules:
    """All tunable parameters of the pipeline, one frozen object."""

    max_age_hours: int = MAX_AGE_HOURS
    min_article_chars: int = MIN_ARTICLE_CHARS
    max_articles_per_feed: int = MAX_ARTICLES_PER_FEED
    simhash_max_distance: int = SIMHASH_MAX_DISTANCE
    cosine_threshold: float = SEMANTIC_COSINE_THRESHOLD
    story_window_hours: int = STORY_WINDOW_HOURS
    window_stories: bool = False  # hold near articles against the window above before leaders are elected (B05)
    importance_weights: dict = field(default_factory=lambda: dict(IMPORTANCE_WEIGHTS))
    risk_weights: dict = field(default_factory=lambda: dict(RISK_WEIGHTS))
    single_source_penalty: float = SINGLE_SOURCE_PENALTY
    top_n_per_domain: int = TOP_N_PER_DOMAIN
    max_per_country: int = MAX_PER_COUNTRY
    include_fringe: bool = INCLUDE_FRINGE
    min_score: float = MIN_SCORE
    use_l2: bool = True
    use_l3: bool = True
    transitive_counts: bool = False

    def __hash__(self):  # dict fields: hash by identity is enough here
        return id(self)


DEFAULT_RULES = Rules()
