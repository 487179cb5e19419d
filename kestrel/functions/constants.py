"""Fixed values.

Everything in this module must equal the values the original platform uses,
because results depend on them. They are listed plainly, in their natural
order, and are not derived from anything.
"""

# --- fixed values: regulatory status -> risk weight; any other status -> default
RISK_WEIGHTS = {
    "restricted": 0.8,
    "banned": 1.0,
    "allowed": 0.1,
    "unknown": 0.4,
}
DEFAULT_RISK_WEIGHT = 0.4
FLAGGED_STATUSES = ("restricted", "banned")

# --- fixed values: common / marketing name -> standard ingredient name
SYNONYMS = {
    "vitamin c": "ascorbic acid",
    "vitamin b3": "niacinamide",
    "tranexamic acid": "trans-4-aminomethylcyclohexanecarboxylic acid",
    "alpha arbutin": "arbutin",
    "aha": "glycolic acid",
    "bha": "salicylic acid",
}

# --- fixed values: the ingredient terms that drive extraction
INGREDIENT_TERMS = [
    "niacinamide", "hydroquinone", "tranexamic acid", "retinoid", "retinol",
    "azelaic acid", "kojic acid", "arbutin", "vitamin c", "ascorbic acid",
    "salicylic acid", "glycolic acid", "lactic acid", "benzoyl peroxide",
    "hyaluronic acid", "ceramide", "peptide", "centella asiatica", "licorice extract",
    "alpha arbutin",
]

# --- fixed values: terms replayed in date windows, window length, paging ceiling
HIGH_VOLUME_TERMS = (
    "vitamin c", "tranexamic acid", "retinol", "retinoid", "ascorbic acid",
    "salicylic acid", "glycolic acid", "lactic acid",
)
CHUNK_DAYS = 90
HIGH_VOLUME_LOOKBACK_DAYS = 365
NO_WATERMARK_START = "1900-01-01"
MISSING_DATE = "19000101"
WINDOW_RECORD_CEILING = 25_000

# --- fixed values: cleaning defaults
STATUS_DEFAULT = "unknown"
FUNCTION_DEFAULT = "unspecified"
REGISTRY_KEPT_COLUMNS = ["inci_name", "function", "regulatory_status"]
REGISTRY_OPTIONAL_COLUMNS = ["concentration_limit"]

# --- fixed values: registry CSV header -> column name
REGISTRY_RENAMES = {
    "INCI name": "inci_name",
    "Restriction": "regulatory_status",
    "Function": "function",
    "CAS No": "cas_no",
    "EC No": "ec_no",
    "COSING Ref No": "cosing_ref_no",
    "Chem/IUPAC Name / Description": "chem_description",
    "Update Date": "update_date",
}

# --- fixed values: data-quality rules per target table
DQ_REQUIRED_COLUMNS = {
    "pubmed_evidence": ["pmid", "ingredient_term", "abstract_length"],
    "cosing_staging": ["inci_name", "function", "regulatory_status"],
    "adverse_events": ["safetyreportid", "receivedate"],
}
DQ_NOT_NULL_COLUMNS = {
    "pubmed_evidence": ["pmid"],
    "cosing_staging": ["inci_name"],
    "adverse_events": ["safetyreportid"],
}
DQ_RANGE_RULES = {
    "pubmed_evidence": {"abstract_length": (1, 5000)},
}

# --- fixed values: batch length allocation
MIN_ALLOCATED_LENGTH = 5

# --- fixed values: range of the calendar dimension
DIM_DATE_FROM = "2010-01-01"
DIM_DATE_TO = "2030-12-31"

# --- fixed values: text features
TFIDF_MAX_FEATURES = 2000
TFIDF_MIN_DF = 2
TOP_KEYWORDS = 30
HISTOGRAM_BINS = 40
RMS_TARGET = 0.1
RMS_EPSILON = 1e-9
SLUG_LENGTH = 60

# --- fixed values: data sources of the star schema (key, name, type, method)
DIM_SOURCE_ROWS = [
    (1, "openFDA", "REST_API", "Paginated GET with exponential backoff + date-range chunking"),
    (2, "PubMed", "REST_API", "NCBI E-utilities esearch/efetch with watermark"),
    (3, "OBF", "REST_API", "Open Beauty Facts category pagination + image download"),
    (4, "CosIng", "flat_file", "Bulk CSV export, truncate-and-reload"),
    (5, "YouTube", "REST_API", "YouTube Data API v3 search + captions"),
    (6, "Podcast", "RSS", "RSS feed parse + MP3 manifest download"),
]

# --- fixed values: English stop-words (the common NLTK list, in its order)
STOPWORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're",
    "you've", "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he",
    "him", "his", "himself", "she", "she's", "her", "hers", "herself", "it", "it's",
    "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "that'll", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does",
    "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as",
    "until", "while", "of", "at", "by", "for", "with", "about", "against", "between",
    "into", "through", "during", "before", "after", "above", "below", "to", "from",
    "up", "down", "in", "out", "on", "off", "over", "under", "again", "further",
    "then", "once", "here", "there", "when", "where", "why", "how", "all", "any",
    "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor",
    "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can",
    "will", "just", "don", "don't", "should", "should've", "now", "d", "ll", "m",
    "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't", "didn",
    "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven",
    "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't",
    "needn", "needn't", "shan", "shan't", "shouldn", "shouldn't", "wasn", "wasn't",
    "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
]
