"""Corpus-word lexicons for the registered queries.

The shipped country/theme/chain lexicons never hit the synthetic driver
prose, so these operators are exercised with words that do occur in it.
They are parameters of the queries, not library defaults.
"""

# (surface, label) — entity gazetteer
CORPUS_GAZETTEER = [
    ("Orre", "GPE"), ("Eriner", "GPE"), ("Ofrehalyon", "GPE"), ("Sich", "ORG"),
    ("Nicht", "PERSON"), ("Anon", "NORP"), ("Reatonsh", "ORG"), ("Hetible", "PERSON"),
]

# (key, country) — ordered country fallback lexicon
CORPUS_COUNTRIES = [
    ("orre", "Orreland"), ("eriner", "Erinia"), ("thon", "Thonia"), ("anea", "Anea"),
]

# domain -> themes (underscore = space in the text)
CORPUS_THEMES = {
    "politics": ["THON", "ERRE", "THING"], "military": ["ANEA", "THON"], "lawfare": ["ERIN", "ATTION"],
    "economics": ["THAN", "ERED"], "trade_sanctions": ["THRE", "ONAN"], "energy_resources": ["THOR", "ERAN"],
    "religion_ideology": ["THIN", "ERST"], "social_unrest": ["THEN", "ERLY"], "demography": ["THOU", "ERAT"],
    "technology_cyber": ["THST", "ERHE"], "information_ops": ["THSH", "ONRE"], "climate_env": ["THLY", "ERES"],
    "health_pandemic": ["THEA", "ERING"],
}

# causal chains with corpus words: trigger {domain, theme}, downstream [{domain, query}], confidence
CORPUS_CHAINS = [
    {"id": "c1", "description": "thon to erre", "trigger": {"domain": "politics", "theme": "THON", "theme_type": "custom"},
     "downstream": [{"domain": "military", "query": "anea thon erre"}, {"domain": "lawfare", "query": "erin attion"}],
     "confidence": 0.85, "source": "manual", "last_reviewed": "2026-03-17"},
    {"id": "c2", "description": "anea to than", "trigger": {"domain": "military", "theme": "ANEA_THON", "theme_type": "custom"},
     "downstream": [{"domain": "economics", "query": "than ered thre"}],
     "confidence": 0.72, "source": "manual", "last_reviewed": "2026-03-17"},
    {"id": "c3", "description": "low confidence", "trigger": {"domain": "politics", "theme": "ERRE", "theme_type": "custom"},
     "downstream": [{"domain": "politics", "query": "thon"}],
     "confidence": 0.5, "source": "manual", "last_reviewed": "2026-03-17"},
]


def topics_with_corpus_themes(topics):
    return [(d, kws, CORPUS_THEMES.get(d, [])) for d, kws, _ in topics]
