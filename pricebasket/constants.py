"""Fixed values the results depend on."""

# Chains in the order the catalogue consolidates them.
CHAINS = ("victory", "shufersal", "ramilevi")

# Registered id of each chain.
CHAIN_IDS = {
    "victory": "7290696200003",
    "shufersal": "7290027600007",
    "ramilevi": "7290058140886",
}

# Display name of each chain.
CHAIN_NAMES = {
    "shufersal": "שופרסל",
    "victory": "ויקטורי",
    "ramilevi": "רמי לוי",
}

# Stores whose price files are taken, per chain. None takes every store.
STORE_ALLOWLIST = {
    "victory": [
        "002", "008", "014", "022", "027", "041", "046", "051", "059", "061",
        "068", "073", "074", "081", "083",
    ],
    "shufersal": [
        "001", "035", "106", "109", "129", "169", "216", "224", "269", "312",
        "361", "362", "374", "477", "780",
    ],
    "ramilevi": [
        "043", "049", "055", "057", "017", "027", "034", "038", "203", "046",
        "008", "014", "033", "035", "050",
    ],
}

# Words that open a conversation, and the heading of a cart summary.
START_WORDS = ("/start", "start", "היי")
SUMMARY_HEADING = "המוצרים בעגלה הם: "

# Local time zone of price files; sizes of the top lists.
LOCAL_ZONE = "Asia/Jerusalem"
TOP_PRODUCTS = 5
NEAREST_STORES = 3

# Weights of a product's popularity in search, and the BM25 defaults.
CHAINS_WEIGHT = 1.0
STORES_WEIGHT = 0.1
BM25_K1 = 1.2
BM25_B = 0.75

# Polarity of a small set of English opinion words, for lexicon sentiment.
# Callers pass their own table for other domains or languages.
LEXICON = {
    "best": 1.0, "excellent": 1.0, "perfect": 1.0, "great": 0.8, "noble": 0.6,
    "good": 0.7, "happy": 0.8, "love": 0.5, "free": 0.4, "nice": 0.6,
    "worthy": 0.5, "honest": 0.6, "fine": 0.4, "cheap": 0.4,
    "worst": -1.0, "terrible": -1.0, "awful": -1.0, "worthless": -0.8,
    "bad": -0.7, "sad": -0.5, "hate": -0.8, "poor": -0.4, "wrong": -0.5,
    "expensive": -0.5, "broken": -0.4,
}

# Words that turn or strengthen the opinion after them; how far a negation reaches and what it multiplies by.
# Callers pass their own table for other languages.
NEGATIONS = ("not", "no", "never", "nicht", "kein", "pas", "jamais", "nunca")
INTENSIFIERS = {"very": 1.3, "really": 1.2, "extremely": 1.5, "so": 1.2, "sehr": 1.3, "zu": 1.2, "très": 1.3, "muy": 1.3, "que": 1.1}
NEGATION_REACH = 3
NEGATED = -0.5
