"""Fixed values.

Everything in this module must stay equal to the behaviour being matched:
patterns, character sets, word lists and defaults.  They are stated as plain
text in natural order and are shared by the Spark code and the DuckDB oracle.
"""

# --- fixed values: sentence normaliser rules (pattern, replacement), applied in order.
# Replacements are written as the text they produce; rules 10-12 produce a
# literal backslash before the bracket or question mark.
SENTENCE_RULES = [
    (r"[^A-Za-z0-9(),!?'`]", " "),
    (r"'s", " 's"),
    (r"'ve", " 've"),
    (r"n't", " n't"),
    (r"'re", " 're"),
    (r"'d", " 'd"),
    (r"'ll", " 'll"),
    (r",", " , "),
    (r"!", " ! "),
    (r"\(", r" \( "),
    (r"\)", r" \) "),
    (r"\?", r" \? "),
    (r"\s{2,}", " "),
]

# --- fixed values: characters a review keeps; everything else becomes a space.
KEEP_PATTERN = r"[^A-Za-z0-9(),!?'`]"

# --- fixed values: HTML entities decoded after tags are removed ("&amp;" last).
HTML_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", "\u00a0"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]

# --- fixed values: characters the frequency tokeniser turns into spaces
# (its default filter set: ASCII punctuation except the apostrophe, plus tab and newline).
FREQ_FILTERS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"

# --- fixed values: English stop-word list (179 words, the widely published list).
STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're",
    "you've", "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he",
    "him", "his", "himself", "she", "she's", "her", "hers", "herself", "it", "it's",
    "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "that'll", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having", "do",
    "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because",
    "as", "until", "while", "of", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above", "below",
    "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t",
    "can", "will", "just", "don", "don't", "should", "should've", "now", "d", "ll",
    "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't",
    "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't",
    "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn",
    "mustn't", "needn", "needn't", "shan", "shan't", "shouldn", "shouldn't",
    "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
]

# --- fixed values: defaults of the original scripts.
MAX_NB_WORDS = 20000          # frequency vocabulary cap: indices 1..19999 are kept
MAX_SEQUENCE_LENGTH = 1000    # first-seen encoding keeps the first 1000 words
SENTENCE_MAX_LEN = 56         # pre-padding length of the sentence data
VALIDATION_SPLIT = 0.2
SEED = 42
LOG_LOSS_EPS = 1e-7           # probability clip of the binary cross-entropy
