"""Fixed values.

Everything in this module is a value that results depend on: thresholds, word
lists, text formats and test inputs.  They are kept together, as plain text, in
their natural order.
"""

# --- quality thresholds ---------------------------------------------------
QUALITY_MIN_TOKENS = 50
QUALITY_MAX_TOKENS = 2000
QUALITY_MIN_STARS = 10
QUALITY_MAX_COMPLEXITY = 8
QUALITY_LANGUAGES = ["python", "javascript", "java", "cpp", "c", "objective-c"]
SHORT_FILE_TOKENS = 1000

# --- popularity weighting -------------------------------------------------
STARS_PER_BOOST = 1000
MAX_BOOST = 2.0

# --- repository domains: the first list with a matching substring wins -------
DOMAIN_KEYWORDS = {
    "web": ["web", "http", "server", "api", "express"],
    "mobile": ["ios", "android", "mobile", "app"],
    "security": ["hack", "security", "vuln", "exploit"],
    "ui": ["ui", "controller", "view", "pager"],
    "automation": ["auto", "script", "bot", "tool"],
}
DOMAIN_DEFAULT = "general"

# --- query expansion and routing --------------------------------------------
QUERY_SYNONYMS = {
    "function": ["method", "procedure", "routine"],
    "array": ["list", "collection", "sequence"],
    "loop": ["iteration", "cycle", "repeat"],
}
COLLECTIONS = ["code_snippets", "documentation", "examples"]
ROUTE_BY_WORD = {
    "implement": ["examples", "code_snippets"],
    "explain": ["documentation"],
}

# --- chunking ---------------------------------------------------------------
CHUNK_SIZE = 512
CHUNK_OVERLAP = 50
CHUNK_WORDS = 800
SEPARATORS = ["\n\n", "\n", " ", ""]
LANGUAGE_SEPARATORS = {
    "python": ["\nclass ", "\ndef "],
    "javascript": ["\nfunction ", "\nconst "],
    "objective-c": ["\nvoid ", "\nint ", "\nstruct "],
    "c": ["\nvoid ", "\nint ", "\nstruct "],
    "cpp": ["\nvoid ", "\nint ", "\nstruct "],
}

# --- text formats -----------------------------------------------------------
BLOCK_SEPARATOR = "\n\n---\n\n"
PASSAGE_PREFIX = "passage: "
QUERY_PREFIX = "query: "
NO_FOLLOW_UP = "no follow-up needed"
SUMMARY_FALLBACK = "Summary unavailable due to LLM error."
UPLOAD_FAILED = "Upload failed"

PROMPTS = {
    "summaries": "Summaries of stored source files, each with its id:\n\n{context}\n\nAnswer from these: {query}\n",
    "documents": "Stored source files with summary, text and id:\n\n{context}\n\nAnswer from these: {query}\n",
    "links": "Summaries of stored source files, each with the address of its text:\n\n{context}\n\nAnswer from these: {query}\n",
    "chunks": "Pieces of source files that were found, each with its summary:\n\n{context}\n\nAnswer from these: {query}\n",
    "reranked": "Source files that were found, best first, each with its text and summary:\n\n{context}\n\nAnswer from these: {query}\n",
    "follow_up": (
        "Asked: {query}\n\nFound so far, best first:\n\n{context}\n\n"
        'If this is enough for an answer, reply "No follow-up needed"; if not, reply with one short query for what is lacking.\n'
    ),
    "generation": "Task: {query}\nFound: {context}\nExamples: {examples}\n\nWrite code that runs, and explain it in a few words.\n",
}

# --- evaluation inputs ------------------------------------------------------
EVALUATION_QUERIES = [
    "How to implement WeChat automation in Python?",
    "Python socket programming examples",
    "How to handle XML parsing in Python?",
    "Express.js server setup with routes",
    "Browser fingerprinting techniques in JavaScript",
    "How to detect user zoom level in browser?",
    "XSS polyglot examples for penetration testing",
    "Network reconnaissance automation scripts",
    "How to implement deanonymization attacks?",
    "iOS UIViewController examples in Objective-C",
    "How to create pager controllers for iOS?",
    "Code from popular GitHub repositories (>1000 stars)",
    "Recent code updates from 2024",
]
PATTERN_CASES = {
    "Create an Express.js server with basic routing": ["express", "app.get", "app.listen", "require"],
    "Python script for network reconnaissance": ["socket", "subprocess", "nmap", "whois"],
}
SNIPPET_CASES = {"Any class, function or import": ["class ", "def ", "import ", "function "]}
POPULARITY_TIERS = {"popular": 1000, "moderate": 100, "all": 0}
TIER_QUERY = "JavaScript automation examples"
TIER_K = 20
