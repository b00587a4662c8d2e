"""Values that must stay exactly as they are for results to be comparable.

Every value here is a fixed value of the data contract: the label set, the
prompt texts, the tag format of an answer and the truncation marker. They are
defaults of operator parameters, so a different contract passes its own.
"""

# Required columns of an article table.
CONTENT = "Content"
SUMMARY = "Summary"
SENTIMENT = "Sentiment"
REQUIRED_COLUMNS = (CONTENT, SUMMARY, SENTIMENT)

# The label domain, in alphabetical (= encoded) order.
LABELS = ("Negative", "Neutral", "Positive")

# Fixed value: the bucket of predictions without a valid label.
UNPARSED = "UNPARSED"

# The prompt texts, the article goes between prefix and suffix.
SYSTEM_PROMPT = """You are a financial news analyst specializing in sentiment analysis.

For each article:
1. Write a brief, factual summary.
2. Classify the sentiment as exactly Positive, Negative, or Neutral.

Return only the requested XML-like format. Do not include reasoning."""

USER_PREFIX = """Analyze this financial news article:

<ARTICLE>
"""

USER_SUFFIX = """
</ARTICLE>

Return:
<SUMMARY>
brief summary
</SUMMARY>
<SENTIMENT>
Positive, Negative, or Neutral
</SENTIMENT>"""

# Fixed value: what replaces the middle of an article that is too long.
TRUNCATION_MARKER = "\n[... article truncated ...]\n"

# Fixed value: share of the kept tokens that come from the start of the article.
HEAD_SHARE = 0.75

# Defaults of a preparation or evaluation run.
DEFAULT_LIMIT = 5000
DEFAULT_TEST_SIZE = 0.1
DEFAULT_SEED = 42
DEFAULT_MAX_LENGTH = 1024
DEFAULT_MAX_EXAMPLES = 200

# Settings that must agree between a training run and its evaluation.
EVALUATION_KEYS = (
    "dataset_id", "dataset_split", "limit", "test_size", "seed", "max_length",
    "no_deduplicate",
)

# Settings that must agree when a training run is resumed.
RESUME_KEYS = (
    "model_id", "dataset_id", "dataset_split", "limit", "test_size", "seed",
    "max_length", "epochs", "max_steps", "learning_rate", "train_batch_size",
    "eval_batch_size", "gradient_accumulation_steps", "lora_r", "lora_alpha",
    "lora_dropout", "lora_targets", "no_deduplicate",
)

# The metrics with a release threshold.
GATED_METRICS = ("sentiment_accuracy", "sentiment_parse_rate", "mean_rouge_l_f1")

# Code points that count as whitespace, as characters and as a
# regular expression class that Java and RE2 read alike.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
OTHER_WHITESPACE_RANGES = (
    r"\t-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WHITESPACE_CLASS = f"[ {OTHER_WHITESPACE_RANGES}]"
NON_WHITESPACE_CLASS = f"[^ {OTHER_WHITESPACE_RANGES}]"

# Fixed value: a word for ROUGE-L.
WORD_PATTERN = r"[\p{L}\p{N}_]+"
