"""Results depend on them, so they are stated as they are."""

# Address spellings to repair, applied one after the other in this order.
ADDRESS_REPAIRS = (
    ("Damr mont", "Damrémont"),
    ("Mont martre", "Montmartre"),
    ("St Ger main", "St Germain"),
    ("P pini re", "Pépinière"),
    ("arr", "Arrondissement"),
    ("Ga t", "Gaite"),
    ("Bail n", "Bailen"),
    ("Gr nentorgasse 30 09", "30 Grünentorgasse"),
    ("Landstra er G rtel 5 03", "5 Landstrasser Guertel"),
    ("Landstra e", "Landstraße"),
    ("Hasenauerstra e 12 19", "12 Hasenauerstrasse"),
    ("D bling", "Döbling"),
    ("Josefst dter Stra e 22 08", "22 Josefstädter Straße"),
    ("Josefst dter Stra e 10 12 08", "10 Josefstädter Straße"),
    ("10 12 08 Josefstadt", "Josefstadt"),
    ("Paragonstra e 1 11", "1 Paragonstrasse"),
    ("Sieveringer Stra e 4 19", "4 Sieveringer Straße Lower Sievering"),
    ("Pau Clar s", "Pau Claris"),
    ("Sep lveda", "Sepulveda"),
    ("Savoyenstra e 2 16", "2 Savoyenstraße"),
    ("W hringer Stra e 33 35 09", "33-35 Währinger Straße"),
    ("W hringer Stra e 12 09", "12 Währinger Straße"),
    ("Taborstra e 8 A 02", "8 Taborstraße"),
)

# Points of interest (monument, latitude, longitude, city).
POINTS_OF_INTEREST = (
    ("Duomo Di Milano", 45.464098, 9.191926, "Milan"),
    ("Navigli", 45.4477413811564, 9.169571064068595, "Milan"),
    ("Piazza Gae Aulenti", 45.48378709120793, 9.189940, "Milan"),
    ("Teatro della Scala", 45.467402, 9.189639885945848, "Milan"),
    ("Bosco Verticale", 45.48568930392492, 9.190674475003226, "Milan"),
    ("Corso Vittorio Emanuele II", 45.465567737473684, 9.19540309682683, "Milan"),
    ("St. Stephen’s Cathedral", 48.20852577021508, 16.373449239305153, "Vienna"),
    ("Centro Storico di Vienna", 48.20883626952154, 16.3698072969758, "Vienna"),
    ("Parlamento d'Austria", 48.207966, 16.359447, "Vienna"),
    ("Stephansplaz", 48.20884776949585, 16.373762327658124, "Vienna"),
    ("Castello del Belvedere di Vienna", 48.191590, 16.380916, "Vienna"),
    ("Houses of Parliament", 51.499479, -0.124809, "London"),
    ("Big Ben", 51.500729, -0.124625, "London"),
    ("Buckingham Palace", 51.501364, -0.141890, "London"),
    ("Piccadilly Circus", 51.510006574648926, -0.1342701740010414, "London"),
    ("Covent Garden", 51.51312719139209, -0.12497164128616164, "London"),
    ("Tower Bridge", 51.506271975942354, -0.0749621868266155, "London"),
    ("Sagrada Familia", 41.403630, 2.174356, "Barcelona"),
    ("Casa Batllo", 41.391700, 2.164918, "Barcelona"),
    ("La Rambla", 41.38572136560806, 2.1698809696297627, "Barcelona"),
    ("Park Guell", 41.414495, 2.152694, "Barcelona"),
    ("Cattedrale Barcelona", 41.383962, 2.176199, "Barcelona"),
    ("Poble Espanyol", 41.368809, 2.148273, "Barcelona"),
    ("Van Gogh Museum", 52.358416, 4.881076, "Amsterdam"),
    ("Anne Frank Huis", 52.375218, 4.883977, "Amsterdam"),
    ("Central Station", 52.378967985429256, 4.899637997382662, "Amsterdam"),
    ("Dam Square", 52.373070, 4.892647, "Amsterdam"),
    ("Vondelpark", 52.357995, 4.868648, "Amsterdam"),
    ("Museum Quarter", 52.35593175295463, 4.885530153036792, "Amsterdam"),
    ("Torre Eiffel", 48.858370, 2.294481, "Paris"),
    ("Cimitero del Père-Lachaise", 48.86182481147705, 2.393300819306622, "Paris"),
    ("Cattedrale Notre-Dame De Paris", 48.852968, 2.349902, "Paris"),
    ("Arco Di Trionfo", 48.873792, 2.295028, "Paris"),
    ("Museo del Louvre", 48.860836940503006, 2.337880031388657, "Paris"),
    ("Pont Alexandre III", 48.86407592011572, 2.313580454682943, "Paris"),
)

# The cities the reviews come from, as they appear in addresses.
CITIES = ("Milan", "Vienna", "Barcelona", "London", "Paris", "Amsterdam")

# Texts that stand for "nothing was written".
NO_POSITIVE = "No Positive"
NO_NEGATIVE = "No Negative"
EMPTY_NEGATIVES = ("nothing", "none", "no negative")
EMPTY_POSITIVES = ("no positive",)

# Words that decide a review on their own.
STRONG_WORDS = ("all", "everything", "always")

# The parts of speech counted as descriptive words (adjective, adverb).
DESCRIPTIVE_POS = ("a", "r")
ADJECTIVE = "a"

# Thresholds of the review rule and of the published compound score.
REVIEW_CUTOFF = 0.3
COMPOUND_CUTOFF = 0.05
COMPOUND_ALPHA = 15.0

# The published rules of the compound score. A negation turns and dampens a valence; an intensifier
# strengthens or weakens it, less so with every word between it and the word it belongs to.
NEGATION_FACTOR = -0.74
DISTANCE_DAMPING = (1.0, 0.95, 0.9)
NEGATIONS = (
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "ain't", "aren't", "can't", "couldn't",
    "daren't", "didn't", "doesn't", "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt", "neither", "don't",
    "hadn't", "hasn't", "haven't", "isn't", "mightn't", "mustn't", "neednt", "needn't", "never", "none", "nope", "nor",
    "not", "nothing", "nowhere", "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent", "oughtn't", "shan't",
    "shouldn't", "uh-uh", "wasn't", "weren't", "without", "wont", "wouldnt", "won't", "wouldn't", "rarely", "seldom",
    "despite",
)
STRENGTHENING = 0.293
STRENGTHENING_WORDS = (
    "absolutely", "amazingly", "awfully", "completely", "considerable", "considerably", "decidedly", "deeply", "enormous",
    "enormously", "entirely", "especially", "exceptional", "exceptionally", "extreme", "extremely", "fabulously", "fully",
    "greatly", "hella", "highly", "hugely", "incredible", "incredibly", "intensely", "major", "majorly", "more", "most",
    "particularly", "purely", "quite", "really", "remarkably", "so", "substantially", "thoroughly", "total", "totally",
    "tremendous", "tremendously", "uber", "unbelievably", "unusually", "utter", "utterly", "very",
)
WEAKENING_WORDS = (
    "almost", "barely", "hardly", "kinda", "kindof", "kind-of", "less", "little", "marginal", "marginally", "occasional",
    "occasionally", "partly", "scarce", "scarcely", "slight", "slightly", "somewhat", "sorta", "sortof", "sort-of",
)

# Further published rules. After a contrast word valences weigh more, before it less; a word in capitals
# among others that are not is stronger, and so is a text with exclamation marks or several question marks.
CONTRAST_WORDS = ("but",)
BEFORE_CONTRAST = 0.5
AFTER_CONTRAST = 1.5
CAPITALS = 0.733
EXCLAMATION = 0.292
MOST_EXCLAMATIONS = 4
QUESTION = 0.18
MOST_QUESTIONS = 3
MANY_QUESTIONS = 0.96

# Endings of compared adjectives and what stands in their place in the base form.
ADJECTIVE_ENDINGS = (("er", ""), ("est", ""), ("er", "e"), ("est", "e"))

# Tokens that the classifying model reads of a text.
MODEL_TOKENS = 512

# Labels of the mean review class of an entity.
VERY_POSITIVE = "Molto Positivo"
FAIRLY_POSITIVE = "Piuttosto Positivo"
VERY_NEGATIVE = "Molto Negativo"
FAIRLY_NEGATIVE = "Piuttosto Negativo"
NEUTRAL = "Neutrale"
NO_REVIEWS = "Nessuna recensione"

# Labels of the yearly mean sentiment.
YEAR_POSITIVE = "Positivo"
YEAR_NEGATIVE = "Negativo"
YEAR_POSITIVE_FROM = 0.4

# Labels of the reputation trend.
IMPROVING = "L'hotel sta migliorando"
WORSENING = "L'hotel sta peggiorando"

# Distance bands in metres, upper bound included.
DISTANCE_BANDS = (
    (500, "Entro 500 metri"),
    (1000, "Tra 500 e 1000 metri"),
    (2000, "Tra 1000 e 2000 metri"),
)

# Mean earth radius in metres.
EARTH_RADIUS = 6371 * 1000.0

# A score from here on counts as a positive review.
POSITIVE_SCORE = 6
