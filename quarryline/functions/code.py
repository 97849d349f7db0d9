"""Column expressions over source files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import DOMAIN_DEFAULT, DOMAIN_KEYWORDS
from .text import col

_C_FAMILY = ["c", "cpp", "objective-c"]

# One pattern per language family; group 1 is the name.
FUNCTION_PATTERNS = {
    "python": r"def\s+(\w+)",
    "javascript": r"function\s+(\w+)",
    "go": r"func\s+(\w+)",
    "braces": r"\b(\w+)\s*\([^()]*\)\s*\{",
    "other": r"(?:def|function)\s+(\w+)",
}
IMPORT_PATTERNS = {
    "python": r"(?:from|import)\s+([\w.]+)",
    "javascript": r"(?:require\(\s*['\x22]|from\s+['\x22]|import\s+)([\w./@-]+)",
    "c_family": r"#\s*(?:include|import)\s*[<\x22]([^>\x22]+)[>\x22]",
    "other": r"import\s+([\w.]+)",
}
BRANCH_WORDS = ["if", "for", "while", "case", "catch", "and", "or"]


def code_type(text: Column | str, path: Column | str) -> Column:
    text, path = col(text), col(path)
    low = F.lower(text)
    scripted = path.endswith(".py") | path.endswith(".js") | path.endswith(".java")
    return (
        F.when(path.endswith(".h"), "header_file")
        .when(scripted & low.contains("class"), "class_definition")
        .when(scripted & (low.contains("function") | text.contains("def ")), "function_implementation")
        .when(scripted & (low.contains("import") | text.contains("require(")), "module_with_imports")
        .otherwise("code_snippet")
    )


def file_type(path: Column | str) -> Column:
    """Text after the last dot of the whole path."""
    path = col(path)
    return F.when(path.contains("."), F.substring_index(path, ".", -1)).otherwise("unknown")


def repo_domain(repo_name: Column | str) -> Column:
    low = F.lower(col(repo_name))
    rules = None
    for domain, words in DOMAIN_KEYWORDS.items():
        hit = low.rlike("|".join(words))
        rules = F.when(hit, domain) if rules is None else rules.when(hit, domain)
    return rules.otherwise(DOMAIN_DEFAULT)


def repo_context(repo_name: Column | str, stars: Column | str, path: Column | str) -> Column:
    return F.struct(
        col(repo_name).alias("repo_name"),
        col(stars).alias("popularity"),
        repo_domain(repo_name).alias("likely_domain"),
        file_type(path).alias("file_type"),
    )


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def functions(text: Column | str, lang: Column | str) -> Column:
    text, lang = col(text), col(lang)
    chain = None
    for name in ("python", "javascript", "go"):
        found = _all(text, FUNCTION_PATTERNS[name])
        chain = F.when(lang == name, found) if chain is None else chain.when(lang == name, found)
    return chain.when(lang.isin("java", *_C_FAMILY), _all(text, FUNCTION_PATTERNS["braces"])).otherwise(
        _all(text, FUNCTION_PATTERNS["other"])
    )


def imports(text: Column | str, lang: Column | str) -> Column:
    text, lang = col(text), col(lang)
    return (
        F.when(lang == "python", _all(text, IMPORT_PATTERNS["python"]))
        .when(lang == "javascript", _all(text, IMPORT_PATTERNS["javascript"]))
        .when(lang.isin(*_C_FAMILY), _all(text, IMPORT_PATTERNS["c_family"]))
        .otherwise(_all(text, IMPORT_PATTERNS["other"]))
    )


def complexity(text: Column | str) -> Column:
    """1 plus the number of branch words."""
    words = F.regexp_extract_all(col(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    branches = F.size(F.filter(words, lambda w: w.isin(*BRANCH_WORDS)))
    return (F.lit(1) + branches).cast("bigint")
