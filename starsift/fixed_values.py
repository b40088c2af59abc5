"""Word lists, lookup tables, thresholds and patterns.

Every value here decides a result, so it is stated as data and passed to the
operators as a default argument. Nothing in this module is logic.
"""

# --- Fixed values: stop words -------------------------------------------------
REVIEW_STOP_WORDS = (
    "i me my we our you your it its am is are was were be been have has had do does did "
    "a an the and but if or as of at by for with to from in on so too very just not also "
    "this that will can would could should got get went go one two "
    "bought buy product item order received delivery"
).split()

JOB_STOP_WORDS = (
    "role position opportunity join team company looking seeking candidate ideal must will able "
    "work working experience knowledge strong good excellent great plus preferred required "
    "requirement skill skills ability responsibilities responsibility qualification qualifications "
    "apply applicant employer employee employment hiring year years month months day days "
    "etc eg ie also well like make get use include including within across along based provide "
    "support ensure help need want"
).split()

# General function words, written for this project; callers may pass a fuller list.
GENERAL_STOP_WORDS = (
    "i me my myself we our ours you your yours he him his she her hers it its they them their "
    "theirs what which who whom this that these those am is are was were be been being have has "
    "had having do does did doing a an the and but if or because as until while of at by for with "
    "about against between into through during before after above below to from up down in out on "
    "off over under again further then once here there when where why how all any both each few "
    "more most other some such no nor not only own same so than too very can will just should now"
).split()

# --- Fixed values: polarity and feature words ----------------------------------
POSITIVE_WORDS = (
    "excellent amazing fantastic love perfect great wonderful outstanding superb best awesome "
    "brilliant good happy satisfied recommend quality worth"
).split()
NEGATIVE_WORDS = (
    "terrible awful worst hate horrible poor bad useless broken defective damaged waste "
    "disappointed refund return never problem issue fake cheap"
).split()
FEATURE_WORDS = (
    "battery screen camera sound design size weight performance speed quality price value "
    "delivery packaging build display charging"
).split()

# --- Fixed values: complaint groups (substring keywords) and severity weights ---
COMPLAINT_KEYWORDS = {
    "Battery Drain": [
        "battery drain", "battery life", "charge fast", "lasts hours", "battery terrible", "recharge",
    ],
    "Build Quality": [
        "broke", "broken", "cracked", "snapped", "plastic", "cheap build", "flimsy", "fell apart",
    ],
    "Defective Unit": [
        "defective", "defect", "manufacturing", "faulty", "not working", "never worked", "doa",
    ],
    "Camera Issues": [
        "blurry", "grainy", "camera quality", "photos bad", "low light", "camera terrible",
    ],
    "Software/App Bugs": [
        "app crash", "crashes", "bugs", "slow app", "not connect", "update", "unusable",
    ],
    "Delivery Problems": [
        "package damaged", "arrived damaged", "late delivery", "shipping slow", "box crushed", "wrong item",
    ],
    "Value for Money": [
        "overpriced", "expensive", "not worth", "better elsewhere", "competitors cheaper", "price",
    ],
    "Customer Service": [
        "customer service", "refused", "no response", "support unhelpful", "warranty denied",
    ],
}
SEVERITY_WEIGHTS = {
    "Defective Unit": 3.0,
    "Build Quality": 2.5,
    "Battery Drain": 2.0,
    "Camera Issues": 1.8,
    "Software/App Bugs": 1.7,
    "Delivery Problems": 1.5,
    "Customer Service": 1.4,
    "Value for Money": 1.2,
}

# --- Fixed values: defect words (substring) -------------------------------------
DEFECT_KEYWORDS = [
    "defective", "defect", "broken", "broke", "cracked", "snapped", "not working", "never worked",
    "manufacturing", "faulty", "doa", "damaged", "malfunction", "stopped working",
]

# --- Fixed values: aspects matched on word boundaries ----------------------------
ASPECT_KEYWORDS = {
    "Battery": ["battery", "charge", "charging", "mah", "power", "drain"],
    "Camera": ["camera", "photo", "picture", "lens", "megapixel", "video"],
    "Display": ["screen", "display", "brightness", "resolution", "amoled"],
    "Build": ["build", "material", "plastic", "metal", "weight", "design"],
    "Software": ["app", "software", "update", "interface", "bug", "crash"],
    "Delivery": ["delivery", "shipping", "packaging", "arrived", "courier"],
    "Value": ["price", "value", "worth", "cost", "expensive", "cheap"],
    "Performance": ["speed", "fast", "slow", "lag", "performance", "processor"],
}
ASPECT_POSITIVE = (
    "excellent amazing great good love perfect outstanding brilliant superb fantastic clear smooth "
    "fast best happy"
).split()
ASPECT_NEGATIVE = (
    "terrible awful poor bad broken worst horrible cheap slow crash blurry defective disappointed "
    "useless avoid"
).split()
ENTITY_ASPECTS = {
    "battery": ["battery", "charge", "charging", "mah", "life", "drain", "fast charge"],
    "camera": ["camera", "photo", "picture", "video", "lens", "megapixel", "mp", "zoom", "selfie"],
    "display": ["screen", "display", "amoled", "lcd", "resolution", "refresh", "brightness"],
    "sound": ["sound", "audio", "speaker", "bass", "volume", "noise", "headphone", "earphone"],
    "performance": ["performance", "speed", "fast", "lag", "processor", "ram", "storage", "hang"],
    "build": ["build", "quality", "design", "material", "plastic", "metal", "glass", "weight"],
    "price": ["price", "value", "cost", "worth", "money", "affordable", "expensive", "cheap"],
    "delivery": ["delivery", "shipping", "packaging", "arrived", "box", "damage", "courier"],
    "software": ["software", "update", "ui", "ux", "interface", "app", "bloatware", "os"],
}
DEFAULT_ASPECTS = [
    "battery", "screen", "display", "camera", "price", "sound", "audio", "software", "shipping",
    "durability",
]
HELPFULNESS_ASPECTS = [
    "battery", "charger", "display", "screen", "camera", "price", "sound", "audio", "shipping",
    "delivery", "service",
]

# --- Fixed values: entity dictionaries -------------------------------------------
BRANDS = (
    "Samsung Apple Sony LG OnePlus Xiaomi Realme Oppo Vivo Motorola Nokia Huawei Google Microsoft "
    "Dell HP Lenovo Asus Acer Toshiba Panasonic Philips Bose JBL Sennheiser boAt Noise Boat "
    "Skullcandy Jabra Anker Portronics Ambrane Nike Adidas Puma Reebok Levi Zara IKEA"
).split()
PRODUCT_FEATURES = (
    "battery screen display camera lens price charging charger sound audio speaker bass mic "
    "microphone software app shipping delivery frame body durability material cord wire"
).split()
MODEL_PATTERNS_SHORT = [
    r"\b[A-Za-z]+\d{1,4}[A-Za-z]?\b",
    r"\b[A-Za-z]+[-]\d{1,4}\b",
]
MODEL_PATTERNS_FULL = [
    r"\b[A-Z]{1,5}[\s\-]?\d{2,6}[A-Za-z]?\b",
    r"\b[A-Z][a-z]+\s+[A-Z]\d{1,3}\b",
    r"\b\d{1,2}th\s+[Gg]en(?:eration)?\b",
    r"\bGen\s*\d\b",
    r"\bv\d+(?:\.\d+)*\b",
    r"\b(?:Pro|Max|Ultra|Plus|Lite|Mini|SE|Air|Note)\b",
]
ENTITY_LABELS = {
    "ORG": "BRAND",
    "PRODUCT": "PRODUCT",
    "GPE": "GPE",
    "LOC": "GPE",
    "MONEY": "MONEY",
    "QUANTITY": "QUANTITY",
    "CARDINAL": "QUANTITY",
    "PERSON": "PERSON",
    "DATE": "DATE",
    "NORP": "ORG",
    "FAC": "PRODUCT",
    "WORK_OF_ART": "PRODUCT",
}
BRAND_CONFIDENCE, FEATURE_CONFIDENCE, MODEL_CONFIDENCE = 0.95, 0.90, 0.85

# --- Fixed values: skills taxonomy ------------------------------------------------
SKILLS = {
    "languages": (
        "python java javascript typescript scala r go golang rust c++ c# kotlin swift ruby php bash "
        "shell perl matlab julia"
    ).split(),
    "ml_ai": [
        "machine learning", "deep learning", "neural network", "nlp", "computer vision",
        "reinforcement learning", "transfer learning", "natural language processing",
        "large language model", "llm", "generative ai", "diffusion model", "transformer",
    ],
    "frameworks": (
        "tensorflow pytorch keras scikit-learn sklearn xgboost lightgbm catboost spacy nltk opencv "
        "fastapi flask django spark hadoop kafka airflow dbt react angular vue node"
    ).split() + ["hugging face"],
    "data": (
        "pandas numpy sql nosql mongodb postgresql mysql sqlite redis elasticsearch tableau looker "
        "excel spark hive presto databricks snowflake"
    ).split() + ["power bi"],
    "cloud_devops": (
        "aws gcp azure docker kubernetes ci/cd git github gitlab jenkins terraform ansible linux unix "
        "mlops devops microservices rest api"
    ).split(),
    "soft_skills": [
        "communication", "collaboration", "leadership", "problem solving", "analytical",
        "critical thinking", "teamwork", "agile", "scrum", "project management", "mentoring",
        "presentation",
    ],
}

# --- Fixed values: extractive summary ----------------------------------------------
OPINION_WORDS = (
    "great excellent good best love amazing perfect terrible worst awful bad poor horrible broken "
    "recommend quality value price taste flavor delicious fresh stale disappointed satisfied worth "
    "cheap expensive favorite outstanding product item purchase order buy bought better worse "
    "compared alternative overall"
).split()
PERSONAL_WORDS = "i my me we our".split()

# --- Fixed values: syllable exceptions ----------------------------------------------
SYLLABLE_EXCEPTIONS = {
    "the": 1, "me": 1, "you": 1, "she": 1, "he": 1, "we": 1, "they": 1, "are": 1, "our": 1,
    "their": 1, "here": 1, "there": 1, "were": 1, "some": 1, "come": 1, "done": 1, "gone": 1,
    "one": 1, "two": 1,
}

# --- Fixed values: columns that are standardised --------------------------------------
SCALED_COLUMNS = [
    "char_count", "word_count", "sentence_count", "avg_word_length", "avg_sentence_length",
    "exclamation_count", "question_count", "caps_ratio", "number_count", "vader_compound",
    "vader_positive", "vader_negative", "positive_word_count", "negative_word_count",
    "lexicon_net_score", "helpful_votes", "log_helpful_votes", "reviewer_review_count",
    "product_avg_rating", "product_rating_std", "rating_deviation",
]
HELPFULNESS_COLUMNS = [
    "word_count", "sentence_count", "char_count", "flesch_reading_ease", "flesch_kincaid_grade",
    "rating_normalized", "time_delta_days", "sentiment_polarity", "sentiment_confidence",
    "entity_density", "aspect_density", "is_topic_assigned",
]

# --- Fixed values: validation gates -----------------------------------------------------
GATES = [
    ("sentiment_weighted_f1", ">=", 0.85),
    ("ner_f1", ">=", 0.80),
    ("aspect_accuracy", ">=", 0.82),
    ("helpfulness_rmse", "<=", 0.12),
]

# --- Fixed values: regular-expression classes shared by all engines ----------------------
WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x0B\x1C-\x1F\x85\p{Z}"
