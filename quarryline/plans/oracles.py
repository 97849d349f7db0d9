"""The catalogue's queries as plain SQL over the same tables, for checking."""

from __future__ import annotations

import re

from .. import constants as C
from ..functions.code import BRANCH_WORDS, FUNCTION_PATTERNS, IMPORT_PATTERNS


def q(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("'", "''") + "'"


S = """S AS (
SELECT doc_id AS original_index,
       concat(CASE n_chars % 5 WHEN 0 THEN 'class A' WHEN 1 THEN 'def f' WHEN 2 THEN 'import x'
                               WHEN 3 THEN 'function g' ELSE '' END, chr(10), text) AS text,
       CASE doc_id % 9 WHEN 0 THEN 'python' WHEN 1 THEN 'javascript' WHEN 2 THEN 'java'
            WHEN 3 THEN 'cpp' WHEN 4 THEN 'c' WHEN 5 THEN 'objective-c' WHEN 6 THEN 'go'
            WHEN 7 THEN '' END AS lang,
       concat(CASE n % 6 WHEN 0 THEN 'http-server' WHEN 1 THEN 'ios-app' WHEN 2 THEN 'vuln-scan'
            WHEN 3 THEN 'pager-view' WHEN 4 THEN 'auto-bot' ELSE 'matrix-core' END, '-', source) AS repo_name,
       concat('org/', CASE n % 6 WHEN 0 THEN 'http-server' WHEN 1 THEN 'ios-app'
            WHEN 2 THEN 'vuln-scan' WHEN 3 THEN 'pager-view' WHEN 4 THEN 'auto-bot'
            ELSE 'matrix-core' END, '-', source) AS repo_full_name,
       (n * n * 37 + n * 5) % 3001 AS star,
       cast(floor(n_chars / 4.0) AS bigint) AS len_tokens,
       concat('src/f', cast(doc_id AS varchar), CASE doc_id % 9 WHEN 0 THEN '.py' WHEN 1 THEN '.js'
            WHEN 2 THEN '.java' WHEN 3 THEN '.cpp' WHEN 4 THEN '.h' WHEN 5 THEN '.m' WHEN 6 THEN '.go'
            ELSE '' END) AS dir,
       date '2023-01-01' + cast(doc_id % 700 AS int) AS created_date,
       date '2024-12-01' + cast(doc_id % 300 AS int) AS updated_date
FROM (SELECT *, cast(substr(source, 4) AS bigint) AS n FROM documents))"""


def sql(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def tok(c: str) -> str:
    return rf"regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}]+')"


def lead(c: str) -> str:
    found = f"regexp_extract_all({c}, '[^.!?]+[.!?]')"
    return f"CASE WHEN len({found}) > 0 THEN array_to_string({found}[1:3], ' ') END"


def summary(c: str) -> str:
    return f"coalesce({lead(c)}, {q(C.SUMMARY_FALLBACK)})"


def strip(c: str) -> str:
    return f"trim({c}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def vectors(name: str, source: str, key: str, text: str) -> str:
    """CTE `name`(key, vec): hashed bag of words of unit length."""
    return f"""{name}_words AS (SELECT {key}, unnest({tok(text)}) AS w FROM {source}),
{name}_counts AS (SELECT {key}, ('0x' || substr(md5(w), 1, 2))::INT % 64 AS b, count(*) AS c
  FROM {name}_words GROUP BY ALL),
{name}_maps AS (SELECT {key}, map_from_entries(list((b, c))) AS m, sqrt(sum(c * c)) AS norm
  FROM {name}_counts GROUP BY {key}),
{name} AS (SELECT s.{key}, list_transform(range(64), lambda i:
    coalesce(map_extract(m, i::INT)[1], 0)::DOUBLE / coalesce(norm, 1.0)) AS vec
  FROM {source} s LEFT JOIN {name}_maps USING ({key}))"""


def cell_counts(name: str, source: str, key: str, text: str) -> str:
    """CTE `name`(key, b, c): how often the words of each hashed cell occur."""
    return f"""{name}_words AS (SELECT {key}, unnest({tok(text)}) AS w FROM {source}),
{name} AS (SELECT {key}, ('0x' || substr(md5(w), 1, 4))::INT % 1024 AS b, count(*) AS c FROM {name}_words GROUP BY ALL)"""


def idf_vectors(name: str, counts: str, df: str, source: str, key: str) -> str:
    """CTE `name`(key, vec): counts times weights of `df`(b, w), at unit length."""
    return f"""{name}_parts AS (SELECT {key}, b, c * coalesce(w, (SELECT max(top) FROM {df})) AS v FROM {counts} LEFT JOIN {df} USING (b)),
{name}_maps AS (SELECT {key}, map_from_entries(list((b, v))) AS m, sqrt(sum(v * v)) AS norm FROM {name}_parts GROUP BY {key}),
{name} AS (SELECT s.{key}, list_transform(range(1024), lambda i: CASE WHEN norm > 0
    THEN coalesce(map_extract(m, i::INT)[1], 0.0) / norm ELSE 0.0 END) AS vec FROM {source} s LEFT JOIN {name}_maps USING ({key}))"""


IDF = (
    cell_counts("C", "S", "original_index", "text"),
    """DF AS (SELECT b, ln((n + 1) / (count(*) + 1.0)) AS w, ln(n + 1.0) AS top FROM C, (SELECT count(*)::DOUBLE AS n FROM S) GROUP BY b, n)""",
)


DIST = "round(list_distance(query_vec, vec), 9)"


def top(name: str, queries: str, corpus: str, k: int, extra: str = "", partition: str = "q_id") -> str:
    """CTE `name`: k nearest corpus rows per query."""
    return f"""{name}_all AS (SELECT q_id, original_index{extra}, {DIST} AS distance FROM {queries}, {corpus}),
{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {partition} ORDER BY distance, original_index) AS rank
  FROM {name}_all) WHERE rank <= {k})"""


BM = "BM AS (SELECT item_id AS q_id, text AS query_text FROM benchmark)"
BQ = vectors("BV", "BM", "q_id", "query_text") + """,
Q AS (SELECT q_id, query_text, vec AS query_vec FROM BM JOIN BV USING (q_id))"""
SV = vectors("V", "S", "original_index", "text")
WEIGHTED = f"round(distance * (1 + least(coalesce(star, 0) / {C.STARS_PER_BOOST}.0, {C.MAX_BOOST})), 9)"
BOOSTED = f"round(distance / (1 + least(coalesce(star, 0) / {C.STARS_PER_BOOST}.0, {C.MAX_BOOST})), 9)"


def given(texts: list[str]) -> str:
    rows = ", ".join(f"({i}, {q(t)})" for i, t in enumerate(texts))
    return f"G(q_id, query_text) AS (VALUES {rows})"


GQ = vectors("GV", "G", "q_id", "query_text") + """,
Q AS (SELECT q_id, query_text, vec AS query_vec FROM G JOIN GV USING (q_id))"""

CODE_TYPE = """CASE WHEN ends_with(dir, '.h') THEN 'header_file'
  WHEN NOT (ends_with(dir, '.py') OR ends_with(dir, '.js') OR ends_with(dir, '.java')) THEN 'code_snippet'
  WHEN contains(lower(text), 'class') THEN 'class_definition'
  WHEN contains(lower(text), 'function') OR contains(text, 'def ') THEN 'function_implementation'
  WHEN contains(lower(text), 'import') OR contains(text, 'require(') THEN 'module_with_imports'
  ELSE 'code_snippet' END"""
FILE_TYPE = "CASE WHEN contains(dir, '.') THEN list_last(string_split(dir, '.')) ELSE 'unknown' END"
DOMAIN = (
    "CASE "
    + " ".join(
        "WHEN " + " OR ".join(f"contains(lower(repo_name), {q(w)})" for w in words) + f" THEN {q(d)}"
        for d, words in C.DOMAIN_KEYWORDS.items()
    )
    + f" ELSE {q(C.DOMAIN_DEFAULT)} END"
)
_BRANCHES = ", ".join(q(w) for w in BRANCH_WORDS)
COMPLEXITY = (
    r"(1 + len(list_filter(regexp_extract_all(text, '[\p{L}\p{N}_]+'), "
    f"lambda w: w IN ({_BRANCHES}))))::BIGINT"
)


def _found(patterns: dict[str, str], name: str) -> str:
    return f"regexp_extract_all(text, {q(patterns[name])}, 1)"


FUNCTIONS = f"""CASE WHEN lang = 'python' THEN {_found(FUNCTION_PATTERNS, 'python')}
  WHEN lang = 'javascript' THEN {_found(FUNCTION_PATTERNS, 'javascript')}
  WHEN lang = 'go' THEN {_found(FUNCTION_PATTERNS, 'go')}
  WHEN lang IN ('java', 'c', 'cpp', 'objective-c') THEN {_found(FUNCTION_PATTERNS, 'braces')}
  ELSE {_found(FUNCTION_PATTERNS, 'other')} END"""
IMPORTS = f"""CASE WHEN lang = 'python' THEN {_found(IMPORT_PATTERNS, 'python')}
  WHEN lang = 'javascript' THEN {_found(IMPORT_PATTERNS, 'javascript')}
  WHEN lang IN ('c', 'cpp', 'objective-c') THEN {_found(IMPORT_PATTERNS, 'c_family')}
  ELSE {_found(IMPORT_PATTERNS, 'other')} END"""

def _string(quote: str) -> str:
    return rf"""{quote}(?:\\.|[^{quote}\\\n])*(?:{quote}|\\\z)?"""


def _triple(quote: str) -> str:
    return rf"""{quote * 3}(?:\\.|[^\\])*?(?:{quote * 3}|\\?\z)"""


# A file as a row of tokens and of what lies between them.
_PYTHON = "(?s)" + "|".join([_triple('"'), _triple("'"), _string('"'), _string("'"), r"#[^\n]*", """[^"'#]+"""])
_BRACES = "(?s)" + "|".join([r"//[^\n]*", r"/\*.*?(?:\*/|\z)", _string('"'), _string("'"), r"`(?:\\.|[^`\\])*(?:`|\\?\z)", "/", """[^/"'`]+"""])
_IN_BRACES = "lang IN ('javascript', 'java', 'cpp', 'c', 'objective-c', 'go')"


def _hidden(what: str, braces_what: str, shown: str) -> str:
    """The text with the tokens that `what` names put as `shown` (an expression over x)."""
    python = f"list_transform(regexp_extract_all(text, {q(_PYTHON)}), lambda x: CASE WHEN {what} THEN {shown} ELSE x END)"
    braces = f"list_transform(regexp_extract_all(text, {q(_BRACES)}), lambda x: CASE WHEN {braces_what} THEN {shown} ELSE x END)"
    return f"CASE WHEN lang = 'python' THEN array_to_string({python}, '') WHEN {_IN_BRACES} THEN array_to_string({braces}, '') ELSE text END"


_QUOTED = """left(x, 1) IN ('"', '''', '#')"""
_BRACED = """(left(x, 1) IN ('"', '''', '`') OR left(x, 2) IN ('//', '/*'))"""
_LONG = "(left(x, 1) = '`' OR left(x, 2) IN ('//', '/*'))"
_LINES_KEPT = r"regexp_replace(x, '[^\n]', chr(1), 'g')"
SHOWN = f"""M AS (SELECT original_index, lang, text, {_hidden(_QUOTED, _BRACED, _LINES_KEPT)} AS shown,
  {_hidden("false", _LONG, _LINES_KEPT)} AS long_shown FROM S)"""
_STARTS = " ".join(
    f"WHEN lang = {q(name)} THEN " + " OR ".join(f"starts_with(following, {q(start[1:])})" for start in own) for name, own in C.LANGUAGE_SEPARATORS.items()
)
_LAST_CUT = "list_max(list_filter({}, lambda x: x > start AND x <= start + 512))"


def _number_of(signs: str) -> str:
    return f"length(regexp_replace(line, '[^{signs}]', '', 'g'))"


CUTS = f"""M AS (SELECT original_index, lang, length(text) AS n, {_hidden(_QUOTED, _BRACED, "repeat(chr(1), length(x))")} AS shown FROM S),
LN AS (SELECT original_index, lang, n, unnest(string_split(shown, chr(10))) AS line, generate_subscripts(string_split(shown, chr(10)), 1) AS i FROM M),
LP AS (SELECT original_index, lang, n, sum(length(line) + 1) OVER w AS pos, lead(line) OVER w AS following, CASE WHEN lang = 'python' OR {_IN_BRACES}
    THEN sum({_number_of('([{')} - {_number_of(r')' + chr(92) + ']}')}) OVER w ELSE 0 END AS depth
  FROM LN WINDOW w AS (PARTITION BY original_index ORDER BY i)),
G AS (SELECT original_index, n, list(pos) FILTER (pos < n AND depth <= 0 AND CASE {_STARTS} ELSE false END) AS c0,
    list(pos) FILTER (pos < n AND depth <= 0) AS c1, list(pos) FILTER (pos < n) AS c2 FROM LP GROUP BY original_index, n),
R AS (SELECT original_index, n, 0::BIGINT AS chunk_no, 0::BIGINT AS start, c0, c1, c2 FROM G WHERE n > 0
  UNION ALL SELECT original_index, n, chunk_no + 1, coalesce({_LAST_CUT.format('c0')}, {_LAST_CUT.format('c1')}, {_LAST_CUT.format('c2')}, start + 512)::BIGINT,
    c0, c1, c2 FROM R WHERE n - start > 512)"""

def replay(seps: str, levels: int) -> list[str]:
    """CTEs that split every text again, level by level, and merge the pieces: SP(original_index, a, b), in characters.

    R: regions still to be split; a level's pieces are short (they join a run) or long (regions of the next level).
    """
    out = [f"R1 AS (SELECT original_index, text, {seps} AS seps, 0::BIGINT AS a, length(text)::BIGINT AS b FROM S WHERE text <> '')"]
    for n in range(1, levels + 1):
        cut = f"CASE WHEN coalesce(seps[{n}], '') = '' THEN [substr(text, a + 1, b - a)] ELSE string_split(substr(text, a + 1, b - a), seps[{n}]) END"
        out += [
            f"X{n} AS (SELECT *, {cut} AS parts FROM R{n})",
            f"U{n} AS (SELECT original_index, a, b, len(parts) AS n, unnest(parts) AS p, generate_subscripts(parts, 1) AS i, length(seps[{n}]) AS w FROM X{n} WHERE len(parts) > 1)",
            f"K{n} AS (SELECT original_index, a, a AS c FROM U{n} UNION SELECT original_index, a, b FROM U{n} UNION SELECT original_index, a, c FROM (SELECT original_index, a, n, i,\n"
            f"    a + sum(length(p) + w) OVER (PARTITION BY original_index, a ORDER BY i) - w AS c FROM U{n}) WHERE i < n)",
            f"P{n} AS (SELECT * FROM (SELECT original_index, a AS region, c AS x, lead(c) OVER (PARTITION BY original_index, a ORDER BY c) AS y FROM K{n}) WHERE y IS NOT NULL)",
            f"G{n} AS (SELECT *, count(*) FILTER (y - x >= 512) OVER (PARTITION BY original_index, region ORDER BY x) AS run FROM P{n})",
            f"Z{n} AS (SELECT original_index, list_prepend(min(x), list(y ORDER BY y))::BIGINT[] AS cuts FROM G{n} WHERE y - x < 512 GROUP BY original_index, region, run)",
            f"R{n + 1} AS (SELECT original_index, text, seps, a, b FROM X{n} WHERE len(parts) = 1 UNION ALL\n"
            f"  SELECT original_index, text, seps, x::BIGINT, y::BIGINT FROM P{n} JOIN (SELECT original_index, text, seps FROM R1) USING (original_index) WHERE y - x >= 512)",
        ]
    runs = " UNION ALL ".join(f"SELECT * FROM Z{n}" for n in range(1, levels + 1))
    reach = "least(len(list_filter(cuts, lambda x: x <= cuts[{f}] + 512)), len(cuts))"
    out += [
        f"ZZ AS ({runs})",
        f"""MG AS (SELECT original_index, cuts, 1::BIGINT AS f, {reach.format(f=1)}::BIGINT AS l FROM ZZ
  UNION ALL SELECT original_index, cuts, g, {reach.format(f='g')}::BIGINT FROM (SELECT original_index, cuts, greatest(f, least(l,
    1 + len(list_filter(cuts, lambda x: x < greatest(cuts[l] - 50, cuts[l + 1] - 512)))))::BIGINT AS g FROM MG WHERE l < len(cuts)))""",
        f"""SP AS (SELECT original_index, cuts[f] AS a, cuts[l] AS b FROM MG UNION ALL SELECT original_index, a + 462 * k, least(a + 462 * k + 512, b)
  FROM (SELECT *, unnest(range(0, greatest(1, ceil((b - a - 50) / 462.0))::BIGINT)) AS k FROM R{levels + 1}))""",
    ]
    return out


def replayed(seps: str, levels: int) -> str:
    """Every chunk of every text, by number, length and hash."""
    return "WITH RECURSIVE " + sql(
        S, *replay(seps, levels), f"CH AS (SELECT original_index, a, {strip('substr(text, a + 1, b - a)')} AS chunk FROM SP JOIN S USING (original_index))",
        select="""SELECT original_index, row_number() OVER (PARTITION BY original_index ORDER BY a) - 1 AS chunk_no, length(chunk) AS n_chars,
  sha256(chunk) AS code_hash FROM CH WHERE chunk <> ''""",
    ).removeprefix("WITH ")


_GENERAL = "[" + ", ".join(f"replace({q(s.replace(chr(10), '~'))}, '~', chr(10))" for s in C.SEPARATORS) + "]"
_BY_LANG = "list_concat(CASE " + " ".join(
    f"WHEN lang = {q(name)} THEN [" + ", ".join(f"replace({q(s.replace(chr(10), '~'))}, '~', chr(10))" for s in own) + "]" for name, own in C.LANGUAGE_SEPARATORS.items()
) + f" ELSE [] END, {_GENERAL})"

PREFIX = """'# Language: ' || coalesce(lang, 'None') || chr(10) || '# Repo: ' || coalesce(repo_name, 'None') || chr(10)
  || '# Stars: ' || coalesce(star::VARCHAR, 'None') || chr(10)"""


def document(c: str) -> str:
    return f"'[SUMMARY]' || chr(10) || {summary(c)} || chr(10) || chr(10) || '[CODE]' || chr(10) || {c}"


def windows(source: str, name: str = "W") -> str:
    """CTE of fixed windows, one row each."""
    return f"""{name} AS (SELECT * EXCLUDE (n), n AS chunk_no, substr(text, 1 + 462 * n, 512) AS chunk,
    sha256(substr(text, 1 + 462 * n, 512)) AS code_hash
  FROM (SELECT *, unnest(range(greatest(ceil((length(text) - 50) / 462.0), 1)::BIGINT)) AS n FROM {source}))"""


KNOWN = "K AS (SELECT DISTINCT doc_id FROM labels)"
STORED = """original_index, {chunk_id} lang, repo_name AS repo, star AS stars, created_date::VARCHAR AS created_at,
  updated_date::VARCHAR AS updated_at, {summary} AS summary, {lead} IS NOT NULL AS summary_ok,
  length({code}) AS n_code, {hash} sha256(text) AS doc_hash, 64::BIGINT AS dim"""
CHUNK_STORE = sql(
    S,
    windows("S"),
    select="SELECT "
    + STORED.format(
        chunk_id="original_index || '_' || chunk_no AS chunk_id,", summary=summary("chunk"), lead=lead("chunk"),
        code="chunk", hash="code_hash,",
    )
    + """ FROM (SELECT *, row_number() OVER (PARTITION BY code_hash ORDER BY original_index, chunk_no) AS r FROM W)
  WHERE r = 1""",
)

MEANS = """M AS (SELECT label::BIGINT AS q_id, list(a ORDER BY i) AS query_vec FROM
  (SELECT label, i, avg(embedding[i]::DOUBLE) AS a FROM embeddings, range(1, 65) r(i) GROUP BY ALL) GROUP BY label)"""
STORED_VECTORS = """E AS (SELECT vec_id AS original_index, embedding::DOUBLE[] AS vec FROM embeddings
  WHERE vec_id IN (SELECT doc_id FROM documents))"""


def ranked(select: str = "q_id, original_index, round(distance, 6) AS distance, rank") -> str:
    return f"SELECT {select} FROM H"


def quality_hits(queries: str, fetch: int = 20, k: int = 10) -> str:
    return top("H", "Q", "V", fetch) + f""",
R AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY weighted_score, original_index) AS place FROM
  (SELECT q_id, original_index, distance, lang, star, {WEIGHTED} AS weighted_score FROM
    (SELECT H.*, lang, star, len_tokens, {COMPLEXITY} AS complexity FROM H JOIN S USING (original_index))
   WHERE len_tokens >= 50 AND star >= 10 AND complexity <= 8)),
RQ AS (SELECT * FROM R WHERE place <= {k})"""


OVERLAP = """CASE WHEN len(list_distinct(list_concat(a, b))) = 0 THEN 0.0
  ELSE round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 9) END"""


def scored(hits: str) -> str:
    """Rows of `hits` with the pair score."""
    return f"""SELECT * EXCLUDE (a, b), {OVERLAP} AS score FROM (
  SELECT h.*, {summary('text')} AS summary, list_distinct({tok('query_text')}) AS a,
    list_distinct({tok(summary('text') + " || chr(10) || text")}) AS b
  FROM {hits} h JOIN S USING (original_index) JOIN Q USING (q_id))"""


MOVED = """C AS (SELECT q_id, list(a ORDER BY i) AS mean_vec FROM (SELECT q_id, i, avg(vec[i]) AS a
  FROM H JOIN V USING (original_index), range(1, 65) r(i) GROUP BY ALL) GROUP BY q_id),
B AS (SELECT q_id, min(distance) AS best FROM H GROUP BY q_id),
Q2 AS (SELECT q_id, list_transform(range(1, 65), lambda i: query_vec[i] + 0.5 * mean_vec[i]) AS query_vec
  FROM Q JOIN C USING (q_id) JOIN B USING (q_id) WHERE best > 0.7)"""
REPLIED = f"""RT AS (SELECT b.item_id AS q_id, n.text AS reply
  FROM benchmark b JOIN benchmark n ON n.item_id = b.item_id + 1),
{vectors("RV", "RT", "q_id", "reply")},
Q2 AS (SELECT q_id, vec AS query_vec FROM RV)"""


def two_round(dedup: bool, second: str = MOVED) -> str:
    union = "SELECT * FROM O UNION ALL SELECT * FROM P2"
    if dedup:
        union = f"""SELECT * EXCLUDE (dup) FROM (SELECT *,
  row_number() OVER (PARTITION BY q_id, original_index ORDER BY round) AS dup FROM ({union})) WHERE dup = 1"""
    return sql(
        S, SV, BM, BQ, top("H", "Q", "V", 3), second, top("H2", "Q2", "V", 3),
        "X1 AS (SELECT q_id, original_index, 1::BIGINT AS round, rank AS prior FROM H)",
        "X2 AS (SELECT q_id, original_index, 2::BIGINT AS round, rank AS prior FROM H2)",
        f"P1 AS ({scored('X1')})",
        f"P2 AS ({scored('X2')})",
        """O AS (SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER
  (PARTITION BY q_id ORDER BY score DESC, prior) AS r FROM P1) WHERE r <= 3)""",
        f"U AS ({union})",
        select="""SELECT q_id, original_index, round, round(score, 6) AS score, rank FROM (SELECT *,
  row_number() OVER (PARTITION BY q_id ORDER BY score DESC, round, prior) AS rank FROM U) WHERE rank <= 3""",
    )


BM25 = f"""D AS (SELECT original_index, {tok('text')} AS words FROM S),
N AS (SELECT count(*) AS n, sum(len(words)) / count(*) AS mean FROM D),
QT AS (SELECT q_id, term, count(*) AS qtf FROM (SELECT q_id, unnest({tok('query_text')}) AS term FROM BM) GROUP BY ALL),
DT AS (SELECT original_index, term, len(words) AS dl, count(*) AS tf
  FROM (SELECT original_index, words, unnest(words) AS term FROM D)
  WHERE term IN (SELECT term FROM QT) GROUP BY original_index, term, len(words)),
DF AS (SELECT term, count(*) AS df FROM DT GROUP BY term),
L_all AS (SELECT q_id, original_index, round(sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5))
    * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / mean))), 9) AS score
  FROM QT JOIN DF USING (term) JOIN DT USING (term), N GROUP BY ALL),
L AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, original_index) AS rank
  FROM L_all WHERE score > 0) WHERE rank <= 10)"""

ANSWERED = """A AS (SELECT u.conv_id || '_' || u.turn AS id, u.text AS query, a.text AS final_answer
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""
ASKED = """AQ AS (SELECT 'turn_' || conv_id || '_' || turn AS q_id, text AS query_text FROM conversations WHERE role = 'user'
  UNION ALL SELECT 'item_' || item_id, text FROM benchmark)"""

FIXED_QUERIES = C.EVALUATION_QUERIES + ["implement a loop over an array", "explain this function"]
EXPANDED = "query_text" + "".join(
    f" || CASE WHEN list_contains({tok('query_text')}, {q(word)}) THEN {q(' ' + ' '.join(words))} ELSE '' END"
    for word, words in C.QUERY_SYNONYMS.items()
)


def blocks(block: str, k: int = 3) -> str:
    return sql(
        S, SV, BM, BQ, top("H", "Q", "V", k),
        select=f"""SELECT q_id, count(*) AS n, string_agg({block}, {q(C.BLOCK_SEPARATOR)} ORDER BY rank) AS text
  FROM H JOIN S USING (original_index) GROUP BY q_id""",
    )


def prompted(template: str, context: str, query: str, examples: str = "''") -> str:
    """A prompt as an expression over a context and a query column."""
    values = {"context": context, "query": f"replace({query}, 'query: ', '')", "examples": examples}
    parts = re.split(r"\{(context|query|examples)\}", C.PROMPTS[template])
    return " || ".join(values[p] if i % 2 else q(p) for i, p in enumerate(parts))


def prompts(template: str, block: str, k: int) -> str:
    return sql(
        f"C AS ({blocks(block, k)})",
        select=f"""SELECT q_id, {prompted(template, 'C.text', 'b.text')} AS prompt
  FROM C JOIN benchmark b ON b.item_id = C.q_id""",
    )


SUMMARY_BLOCK = f"'Summary: ' || {summary('text')} || chr(10) || 'DB ID: ' || original_index"
DOCUMENT_BLOCK = (
    f"'Summary: ' || {summary('text')} || chr(10) || 'Code:' || chr(10) || '```' || text || '```' || chr(10) || 'DB ID: ' || original_index"
)
NUMBERED_BLOCK = f"""chr(10) || 'Document ' || rank || ':' || chr(10) || 'Summary:' || chr(10) || {summary('text')} || chr(10)
  || chr(10) || 'Code:' || chr(10) || substr(text, 1, 800) || chr(10)"""
LINK_BLOCK = f"""'Summary: ' || {summary('text')} || chr(10)
  || 'S3 Link: https://corpus.s3.amazonaws.com/code_docs/' || sha256(text) || '.txt'"""
RERANKED_BLOCK = f"""'Code:' || chr(10) || text || chr(10) || chr(10) || 'Summary: ' || {summary('text')} || chr(10)
  || 'DB ID: ' || original_index"""

PROFILE_TYPES = {
    "original_index": "bigint", "text": "string", "lang": "string", "repo_name": "string",
    "repo_full_name": "string", "star": "bigint", "len_tokens": "bigint", "dir": "string",
    "created_date": "date", "updated_date": "date",
}

ORACLES: dict[str, str] = {
    "slice_scan": sql(S, select="SELECT original_index, lang, len_tokens FROM S WHERE original_index >= 0 AND original_index < 10000"),
    "profile": sql(
        S,
        select=" UNION ALL ".join(
            f"SELECT {q(c)} AS column_name, {q(t)} AS data_type, count({c}) AS non_null, count(*) AS n_rows FROM S"
            for c, t in PROFILE_TYPES.items()
        ),
    ),
    "sample_rows": sql(S, select="SELECT original_index, text, lang, star, dir FROM S ORDER BY original_index LIMIT 5"),
    "rename": sql(
        S,
        select="""SELECT text AS code, lang AS language, dir AS file_path, repo_name, repo_full_name,
  star AS star_count, len_tokens AS token_count, created_date, updated_date FROM S""",
    ),
    "quality_filter": sql(
        S,
        select="""SELECT original_index, lang, star, len_tokens FROM S WHERE len_tokens BETWEEN 50 AND 2000
  AND star >= 10 AND lang IN ('python', 'javascript', 'java', 'cpp', 'c', 'objective-c')""",
    ),
    "short_lang_filter": sql(
        S, select="SELECT original_index, lang, star, len_tokens FROM S WHERE lang <> '' AND len_tokens < 1000"
    ),
    "lang_counts": sql(S, select="SELECT lang, count(*) AS n FROM S WHERE lang IS NOT NULL GROUP BY lang"),
    "avg_tokens": sql(
        S, select="SELECT lang, round(avg(len_tokens), 6) AS avg_tokens FROM S WHERE lang IS NOT NULL GROUP BY lang"
    ),
    "top_repos": sql(
        S, select="SELECT original_index, repo_name, star, lang FROM S ORDER BY star DESC, original_index LIMIT 10"
    ),
    "code_type": sql(S, select=f"SELECT original_index, {CODE_TYPE} AS code_type FROM S"),
    "repo_context": sql(
        S,
        select=f"""SELECT original_index, repo_name, star AS popularity, {DOMAIN} AS likely_domain,
  {FILE_TYPE} AS file_type FROM S""",
    ),
    "content_hash": sql(S, select="SELECT original_index, sha256(text) AS code_hash FROM S"),
    "extract_functions": sql(
        S, select=f"SELECT original_index, len(f) AS n, array_to_string(f, ',') AS names FROM (SELECT *, {FUNCTIONS} AS f FROM S)"
    ),
    "extract_imports": sql(
        S, select=f"SELECT original_index, len(f) AS n, array_to_string(f, ',') AS names FROM (SELECT *, {IMPORTS} AS f FROM S)"
    ),
    "complexity": sql(S, select=f"SELECT original_index, {COMPLEXITY} AS complexity_score FROM S"),
    "code_scan": sql(
        S, SHOWN,
        select=f"""SELECT original_index, length(shown) - length(replace(shown, chr(1), '')) AS n_masked, length(shown) AS n_chars,
  array_to_string({FUNCTIONS.replace("text", "shown")}, ',') AS functions,
  array_to_string({IMPORTS.replace("text", "(CASE WHEN lang = 'python' THEN shown ELSE long_shown END)")}, ',') AS imports,
  {COMPLEXITY.replace("text", "shown")} AS complexity_score FROM M""",
    ),
    "chunk_nested": "WITH RECURSIVE " + sql(
        S, CUTS,
        select=f"""SELECT original_index, chunk_no, start, CASE WHEN n - start <= 512 THEN n ELSE coalesce({_LAST_CUT.format('c0')},
    {_LAST_CUT.format('c1')}, {_LAST_CUT.format('c2')}, start + 512) END::BIGINT AS "end",
  CASE WHEN n - start <= 512 OR {_LAST_CUT.format('c0')} IS NOT NULL THEN 0 WHEN {_LAST_CUT.format('c1')} IS NOT NULL THEN 1
    WHEN {_LAST_CUT.format('c2')} IS NOT NULL THEN 2 ELSE 3 END::INT AS level FROM R""",
    ).removeprefix("WITH "),
    "chunk_recursive_rows": replayed(_GENERAL, 3),
    "chunk_by_lang_rows": replayed(_BY_LANG, 6),
    "enhanced_metadata": sql(
        S,
        select=f"""SELECT original_index, lang AS language, repo_name, star AS repo_popularity, dir AS file_path,
  len_tokens AS token_count, {COMPLEXITY} AS complexity_score, {CODE_TYPE} AS code_type,
  array_to_string({FUNCTIONS}, ',') AS functions, array_to_string({IMPORTS}, ',') AS imports,
  {DOMAIN} AS likely_domain, {FILE_TYPE} AS file_type, updated_date::VARCHAR AS last_updated FROM S""",
    ),
    "doc_metadata": sql(
        S,
        select="""SELECT original_index, length(text) AS n_text, lang AS language, created_date::VARCHAR AS created_date,
  updated_date::VARCHAR AS updated_date, repo_name AS repo, repo_full_name, star AS stars,
  len_tokens AS length_tokens, dir, 'documents' AS source FROM S WHERE lang <> '' AND len_tokens < 1000""",
    ),
    "embed_text": sql(
        S,
        select=f"""SELECT original_index, 'passage: ' || {PREFIX} || {summary('text')} AS passage,
  'query: ' || {summary('text')} AS query, replace({summary('text')}, 'query: ', '') AS bare FROM S""",
    ),
    "doc_text": sql(S, select=f"SELECT original_index, {document('text')} AS document FROM S"),
    "preview": sql(
        S,
        select="SELECT original_index, "
        + ", ".join(f"substr(text, 1, {n}) AS first_{n}" for n in (300, 400, 600, 800, 2048, 3000)) + " FROM S",
    ),
    "after_marker": sql(
        S,
        select=f"""SELECT original_index, {strip(f"list_last(string_split({document('text')}, '[CODE]'))")} AS after_code,
  {strip("list_last(string_split(text, '```'))")} AS after_fence,
  {strip(f"replace({document('text')}, text, '')")} AS head FROM S""",
    ),
    "vector_profile": """SELECT vec_id, len(embedding) AS dim,
  round(list_sum(embedding[1:10]::DOUBLE[]), 6) AS first_ten_sum,
  round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm FROM embeddings""",
    "vector_text": """SELECT vec_id, len(embedding) AS n, round(embedding[1]::DOUBLE, 6) AS first_value,
  round(embedding[-1]::DOUBLE, 6) AS last_value, true AS bracketed FROM embeddings""",
    "topk_dense": sql(MEANS, STORED_VECTORS, top("H", "M", "E", 3), select=ranked()),
    "topk_pruned": sql(MEANS, STORED_VECTORS, top("H", "M", "E", 3), select=ranked()),
    "topk_cosine": sql(
        MEANS, "E AS (SELECT vec_id AS original_index, embedding::DOUBLE[] AS vec FROM embeddings)",
        """H_all AS (SELECT q_id, original_index, round(list_cosine_distance(query_vec, vec), 9) AS distance FROM M, E),
H AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY distance, original_index) AS rank
  FROM H_all) WHERE rank <= 3)""",
        select=ranked(),
    ),
    "topk_filtered": sql(
        S, "SF AS (SELECT * FROM S WHERE lang <> '' AND len_tokens < 1000)",
        vectors("V", "SF", "original_index", "text"), BM, BQ, top("H", "Q", "V", 3), select=ranked(),
    ),
    "min_stars_search": sql(
        S, "SF AS (SELECT * FROM S WHERE star >= 100)", vectors("V", "SF", "original_index", "text"), BM, BQ,
        top("H", "Q", "V", 20), select=ranked(),
    ),
    **{
        key: sql(
            S, SV, BM, BQ, top("H", "Q", "V", 20),
            f"X AS (SELECT q_id, original_index, distance, {formula} AS weighted_score FROM H JOIN S USING (original_index))",
            select="""SELECT q_id, original_index, round(distance, 6) AS distance, round(weighted_score, 6) AS weighted_score,
  row_number() OVER (PARTITION BY q_id ORDER BY X.weighted_score, original_index) AS rank FROM X""",
        )
        for key, formula in (("topk_weighted", WEIGHTED), ("topk_boosted", BOOSTED))
    },
    "quality_search": sql(
        S, SV, BM, BQ, quality_hits("Q"),
        select="""SELECT q_id, original_index, round(distance, 6) AS distance, round(weighted_score, 6) AS weighted_score,
  place AS rank FROM RQ""",
    ),
    "domain_search": sql(
        S, SV, BM, BQ, top("H", "Q", "V", 50),
        f"""X AS (SELECT q_id, original_index, distance, {WEIGHTED} AS weighted_score, row_number() OVER
  (PARTITION BY q_id ORDER BY distance, original_index) AS place
  FROM H JOIN S USING (original_index) WHERE {DOMAIN} = 'web')""",
        select="""SELECT q_id, original_index, round(distance, 6) AS distance, round(weighted_score, 6) AS weighted_score,
  place AS rank FROM X WHERE place <= 10""",
    ),
    "quality_search_full": sql(
        S, SV, BM, BQ,
        f"VQ AS (SELECT V.* FROM V JOIN S USING (original_index) WHERE len_tokens >= 50 AND star >= 10 AND {COMPLEXITY} <= 8)",
        top("H", "Q", "VQ", 20),
        f"""R AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY weighted_score, original_index) AS place FROM
  (SELECT q_id, original_index, distance, {WEIGHTED} AS weighted_score FROM H JOIN S USING (original_index)))""",
        select="""SELECT q_id, original_index, round(distance, 6) AS distance, round(weighted_score, 6) AS weighted_score,
  place AS rank FROM R WHERE place <= 10""",
    ),
    "domain_search_full": sql(
        S, SV, BM, BQ, f"VD AS (SELECT V.* FROM V JOIN S USING (original_index) WHERE {DOMAIN} = 'web')", top("H", "Q", "VD", 10),
        select=f"""SELECT q_id, original_index, round(distance, 6) AS distance, round({WEIGHTED}, 6) AS weighted_score,
  rank FROM H JOIN S USING (original_index)""",
    ),
    "topk_stored": sql(
        S, SV, BM, BQ, top("H", "Q", "V", 3),
        select="SELECT q_id, original_index, lang, repo_name, star, round(distance, 6) AS distance, rank FROM H JOIN S USING (original_index)",
    ),
    "context": blocks(DOCUMENT_BLOCK),
    "prompt": prompts("summaries", SUMMARY_BLOCK, 3),
    "context_chunks": blocks(document("text"), 5),
    "context_links": prompts("links", LINK_BLOCK, 5),
    "follow_up_prompt": blocks(NUMBERED_BLOCK),
    "follow_up_prompt_full": prompts("follow_up", NUMBERED_BLOCK, 3),
    "generation_prompt": sql(
        f"C AS ({blocks(SUMMARY_BLOCK, 5)})", f"X AS ({blocks(NUMBERED_BLOCK, 3)})",
        select=f"""SELECT q_id, {prompted('generation', 'C.text', 'b.text', 'X.text')} AS prompt
  FROM C JOIN X USING (q_id) JOIN benchmark b ON b.item_id = q_id""",
    ),
    "prompt_documents": prompts("documents", DOCUMENT_BLOCK, 3),
    "prompt_chunks": prompts("chunks", document("text"), 5),
    "chunk_fixed": sql(
        S, windows("S"),
        select="""SELECT original_index, chunk_no, original_index || '_' || chunk_no AS chunk_id,
  length(chunk) AS n_chars, code_hash FROM W""",
    ),
    **{
        key: """SELECT doc_id AS original_index, true AS has_chunk, true AS max_len_ok, true AS all_substrings,
  true AS starts_ok, true AS ends_ok, true AS enough_chunks FROM documents"""
        for key in ("chunk_recursive", "chunk_by_lang")
    },
    "chunk_by_words": "SELECT doc_id AS original_index, true AS max_words_ok, true AS whole FROM documents",
    "summary_lead3": sql(
        S, select=f"SELECT original_index, {summary('text')} AS summary, {lead('text')} IS NOT NULL AS summary_ok FROM S"
    ),
    "embed_default": sql(
        S, SV,
        select="""SELECT original_index, len(vec) AS dim, len(list_filter(vec, lambda x: x > 0)) AS n_set,
  round(sqrt(list_dot_product(vec, vec)), 6) AS norm, round(list_max(vec), 6) AS largest,
  list_position(vec, list_max(vec))::BIGINT AS largest_at FROM V""",
    ),
    "embed_idf": sql(
        S, *IDF, "SE AS (SELECT * FROM S WHERE original_index % 2 = 0)", "CE AS (SELECT * FROM C WHERE original_index % 2 = 0)",
        """DFE AS (SELECT b, ln((n + 1) / (count(*) + 1.0)) AS w, ln(n + 1.0) AS top FROM CE, (SELECT count(*)::DOUBLE AS n FROM SE) GROUP BY b, n)""",
        idf_vectors("V", "C", "DF", "S", "original_index"), idf_vectors("VE", "CE", "DFE", "SE", "original_index"),
        select="""SELECT original_index, len(list_filter(V.vec, lambda x: x > 0)) AS n_set, round(list_dot_product(V.vec, V.vec), 6) AS norm,
  round(list_max(V.vec), 6) AS largest, round(list_dot_product(V.vec, range(1, 1025)::DOUBLE[]), 3) AS moment,
  round(list_dot_product(VE.vec, range(1, 1025)::DOUBLE[]), 3) AS moment_before FROM V LEFT JOIN VE USING (original_index)""",
    ),
    "topk_idf": sql(
        S, *IDF, idf_vectors("V", "C", "DF", "S", "original_index"), BM, cell_counts("QC", "BM", "q_id", "query_text"),
        idf_vectors("QV", "QC", "DF", "BM", "q_id"), "Q AS (SELECT q_id, vec AS query_vec FROM QV)", top("H", "Q", "V", 3), select=ranked(),
    ),
    "lexical_topk": sql(
        S, BM, BM25,
        select="SELECT q_id AS item_id, original_index AS doc_id, round(score, 6) AS score, rank FROM L",
    ),
    "lexical_stored": sql(
        S, BM, BM25,
        select="SELECT q_id AS item_id, original_index AS doc_id, round(score, 6) AS score, rank FROM L",
    ),
    "skip_known_docs": "SELECT doc_id AS original_index FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "chunk_dedup": sql(
        S, KNOWN, windows("S"),
        select="""SELECT original_index, chunk_no, code_hash FROM (SELECT *, row_number() OVER
  (PARTITION BY code_hash ORDER BY original_index, chunk_no) AS r FROM W
  WHERE original_index NOT IN (SELECT doc_id FROM K)
  AND code_hash NOT IN (SELECT code_hash FROM W WHERE original_index IN (SELECT doc_id FROM K))) WHERE r = 1""",
    ),
    "ingest": sql(
        S, KNOWN, windows("S"),
        f"""T AS (SELECT *, CASE WHEN original_index IN (SELECT doc_id FROM K) THEN 0 ELSE 1 END::BIGINT AS batch_id,
  {lead('chunk')} IS NOT NULL AS ok FROM W),
F AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY code_hash ORDER BY batch_id, original_index, chunk_no) AS r
  FROM T) WHERE r = 1)""",
        select="""SELECT batch_id, count(*) AS n_rows, count(DISTINCT code_hash) AS n_distinct_hash,
  count(*) FILTER (NOT ok) AS n_bad FROM F GROUP BY batch_id""",
    ),
    "ingest_recursive": """SELECT true AS no_repeats, true AS max_len_ok, 0::BIGINT AS n_second_run, true AS vectors_ok""",
    "code_docs": CHUNK_STORE,
    "stream_ingest": CHUNK_STORE,
    "chunk_search": sql(
        S, windows("S"),
        f"""F AS (SELECT *, sha256(original_index || '_' || chunk_no || '_' || code_hash) AS id,
    'passage: ' || coalesce({lead('chunk')}, chunk) AS passage
  FROM (SELECT *, row_number() OVER (PARTITION BY code_hash ORDER BY original_index, chunk_no) AS r FROM W)
  WHERE r = 1)""",
        vectors("FV", "F", "id", "passage"),
        "BM AS (SELECT item_id AS q_id, 'query: ' || text AS query_text FROM benchmark)", BQ,
        f"""H_all AS (SELECT q_id, id, round(list_distance(query_vec, vec::FLOAT[]::DOUBLE[]), 9) AS distance FROM Q, FV),
H AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY distance, id) AS rank FROM H_all)
  WHERE rank <= 3)""",
        select="""SELECT q_id, original_index, original_index || '_' || chunk_no AS chunk_id, repo_name AS repo, star AS stars,
  round(distance, 6) AS distance, rank FROM H JOIN F USING (id)""",
    ),
    "code_docs_whole": sql(
        S,
        select="SELECT "
        + STORED.format(chunk_id="", summary=summary("text"), lead=lead("text"), code="text", hash="") + " FROM S",
    ),
    **{
        key: sql(
            S, KNOWN, windows("S"),
            select=f"""SELECT 'chunk_' || (row_number() OVER (ORDER BY {order}original_index, chunk_no) - 1) AS id,
  sha256({document('chunk')}) AS document_hash, 64::BIGINT AS dim, original_index || '_' || chunk_no AS chunk_id,
  original_index, lang, repo_name AS repo, star AS stars, created_date::VARCHAR AS created,
  updated_date::VARCHAR AS updated FROM W""",
        )
        for key, order in (("collection_add", ""), ("collection_grow", "original_index NOT IN (SELECT doc_id FROM K), "))
    },
    "whole_search": sql(
        S, f"F AS (SELECT *, 'passage: ' || {lead('text')} AS passage FROM S WHERE {lead('text')} IS NOT NULL)",
        vectors("FV", "F", "original_index", "passage"), "BM AS (SELECT item_id AS q_id, 'query: ' || text AS query_text FROM benchmark)", BQ,
        """H_all AS (SELECT q_id, original_index, round(list_distance(query_vec, vec::FLOAT[]::DOUBLE[]), 9) AS distance FROM Q, FV),
H AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY distance, original_index) AS rank FROM H_all) WHERE rank <= 3)""",
        select=f"""SELECT q_id, original_index, repo_name AS repo, star AS stars, sha256({lead('text')}) AS summary_hash,
  round(distance, 6) AS distance, rank FROM H JOIN S USING (original_index)""",
    ),
    "collection_search": sql(
        S, windows("S"),
        f"""F AS (SELECT *, 'chunk_' || (row_number() OVER (ORDER BY original_index, chunk_no) - 1) AS id,
    'passage: ' || {PREFIX} || {summary('chunk')} AS passage FROM W)""",
        vectors("FV", "F", "id", "passage"), "BM AS (SELECT item_id AS q_id, 'query: ' || text AS query_text FROM benchmark)", BQ,
        """H_all AS (SELECT q_id, id, round(list_distance(query_vec, vec::FLOAT[]::DOUBLE[]), 9) AS distance FROM Q, FV),
H AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY distance, id) AS rank FROM H_all) WHERE rank <= 5)""",
        select="""SELECT q_id, id, original_index || '_' || chunk_no AS chunk_id, repo_name AS repo, round(distance, 6) AS distance, rank
  FROM H JOIN F USING (id)""",
    ),
    "vector_sink": sql(
        S, "SF AS (SELECT * FROM S WHERE lang <> '' AND len_tokens < 1000)",
        vectors("V", "SF", "original_index", "text"),
        select="""SELECT original_index, round(list_dot_product(vec, vec), 6) AS square,
  round(vec[1], 6) AS first_value FROM V""",
    ),
    "blob_index": sql(
        S,
        select=f"""SELECT original_index, {summary('text')} AS summary,
  'https://corpus.s3.amazonaws.com/code_docs/' || sha256(text) || '.txt' AS url, length(text) AS n_body FROM S""",
    ),
    "rerank": sql(
        S, SV, BM, BQ, top("H", "Q", "V", 10),
        "X AS (SELECT q_id, original_index, rank AS prior_rank FROM H)",
        f"P AS ({scored('X')})",
        select="""SELECT q_id, original_index, round(score, 6) AS score, prior_rank, rank FROM (SELECT *,
  row_number() OVER (PARTITION BY q_id ORDER BY score DESC, prior_rank) AS rank FROM P) WHERE rank <= 3""",
    ),
    "rerank_proximity": sql(
        S, SV, BM, BQ, top("H", "Q", "V", 10),
        f"""PR AS (SELECT q_id, original_index, h.rank AS prior_rank, list_distinct({tok('query_text')}) AS a,
    {tok(summary('text') + " || chr(10) || text")} AS b FROM H h JOIN S USING (original_index) JOIN Q USING (q_id)),
OC AS (SELECT q_id, original_index, w, i FROM (SELECT q_id, original_index, a, unnest(b) AS w, generate_subscripts(b, 1) AS i FROM PR) WHERE list_contains(a, w)),
KW AS (SELECT DISTINCT q_id, original_index, w FROM OC),
ST AS (SELECT o.q_id, o.original_index, o.i AS start, k.w FROM OC o JOIN KW k USING (q_id, original_index)),
NX AS (SELECT s.q_id, s.original_index, s.start, s.w, o.i FROM ST s ASOF LEFT JOIN OC o ON s.q_id = o.q_id AND s.original_index = o.original_index AND s.w = o.w AND s.start <= o.i),
WI AS (SELECT q_id, original_index, start, count(*) AS kinds, CASE WHEN count(i) = count(*) THEN max(i) - start + 1 END AS width FROM NX GROUP BY q_id, original_index, start),
PX AS (SELECT q_id, original_index, any_value(kinds) AS kinds, min(width) AS width FROM WI GROUP BY q_id, original_index),
P AS (SELECT q_id, original_index, prior_rank, round(coalesce(kinds / len(a) * (kinds / width), 0.0), 9) AS score FROM PR LEFT JOIN PX USING (q_id, original_index))""",
        select="""SELECT q_id, original_index, round(score, 6) AS score, prior_rank, rank FROM (SELECT *,
  row_number() OVER (PARTITION BY q_id ORDER BY score DESC, prior_rank) AS rank FROM P) WHERE rank <= 3""",
    ),
    "two_round": two_round(False),
    "two_round_dedup": two_round(True),
    "two_round_replies": two_round(False, REPLIED),
    "two_round_prompt": sql(
        S, BM, f"T AS ({two_round(False)})",
        f"""C AS (SELECT q_id, string_agg({RERANKED_BLOCK}, {q(C.BLOCK_SEPARATOR)} ORDER BY rank) AS context
  FROM T JOIN S USING (original_index) GROUP BY q_id)""",
        select=f"SELECT q_id, {prompted('reranked', 'context', 'query_text')} AS prompt FROM C JOIN BM USING (q_id)",
    ),
    "serve": sql(
        S, SV, ANSWERED, ASKED,
        "AA AS (SELECT query, arg_min(final_answer, id) AS final_answer FROM A GROUP BY query)",
        "OQ AS (SELECT min(q_id) AS q_id, query_text FROM AQ WHERE query_text NOT IN (SELECT query FROM A) GROUP BY query_text)",
        vectors("OV", "OQ", "q_id", "query_text"),
        "Q AS (SELECT q_id, vec AS query_vec FROM OV)",
        top("H", "Q", "V", 3),
        f"""X AS (SELECT q_id, string_agg({SUMMARY_BLOCK}, {q(C.BLOCK_SEPARATOR)} ORDER BY rank) AS context
  FROM H JOIN S USING (original_index) GROUP BY q_id)""",
        select=f"""SELECT q_id, query_text, AA.query IS NOT NULL AS cached, final_answer,
  {prompted('summaries', 'context', 'query_text')} AS prompt
  FROM AQ LEFT JOIN AA ON AA.query = AQ.query_text
  LEFT JOIN (SELECT query_text, context FROM X JOIN OQ USING (q_id)) USING (query_text)""",
    ),
    "answer_cache": sql(
        ANSWERED, ASKED,
        "AA AS (SELECT query, arg_min(final_answer, id) AS final_answer FROM A GROUP BY query)",
        select="""SELECT q_id, query_text, AA.query IS NOT NULL AS cached, final_answer
  FROM AQ LEFT JOIN AA ON AA.query = AQ.query_text""",
    ),
    "cache_misses": sql(
        ANSWERED, ASKED, select="SELECT q_id, query_text FROM AQ WHERE query_text NOT IN (SELECT query FROM A)"
    ),
    "query_log": sql(
        S, SV, "BM AS (SELECT min(item_id) AS q_id, text AS query_text FROM benchmark GROUP BY text)", BQ, ANSWERED, top("H", "Q", "V", 10),
        "X AS (SELECT q_id, original_index, rank AS prior_rank FROM H)",
        f"P AS ({scored('X')})",
        """R AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, prior_rank) AS rank
  FROM P) WHERE rank <= 3)""",
        select=f"""SELECT query_text AS query, r1.summary AS final_answer,
  (SELECT string_agg(original_index::VARCHAR, ',' ORDER BY rank) FROM H WHERE H.q_id = Q.q_id) AS retrieved_doc_ids,
  (SELECT string_agg(original_index::VARCHAR, ',' ORDER BY rank) FROM R WHERE R.q_id = Q.q_id) AS final_doc_ids
  FROM Q JOIN R r1 ON r1.q_id = Q.q_id AND r1.rank = 1
  WHERE query_text NOT IN (SELECT query FROM A) AND r1.summary <> {q(C.SUMMARY_FALLBACK)}""",
    ),
    "query_expand": sql(
        given(FIXED_QUERIES), ASKED,
        select=f"""SELECT q_id, query_text, {EXPANDED} AS expanded FROM
  (SELECT 'text_' || q_id AS q_id, query_text FROM G UNION ALL SELECT * FROM AQ)""",
    ),
    "section_route": sql(
        S, SV, given(FIXED_QUERIES), GQ,
        f"""SC AS (SELECT original_index, vec, CASE WHEN kind IN ('class_definition', 'function_implementation')
  THEN 'code_snippets' WHEN kind = 'code_snippet' THEN 'documentation' ELSE 'examples' END AS collection
  FROM (SELECT original_index, {CODE_TYPE} AS kind FROM S) JOIN V USING (original_index)),
X AS (SELECT q_id, collection, original_index, {DIST} AS distance FROM Q, SC WHERE CASE
  WHEN contains(lower(query_text), 'implement') THEN collection IN ('examples', 'code_snippets')
  WHEN contains(lower(query_text), 'explain') THEN collection = 'documentation' ELSE true END)""",
        select="""SELECT q_id::BIGINT AS q_id, collection, original_index, round(distance, 6) AS distance, rank FROM (SELECT *,
  row_number() OVER (PARTITION BY q_id ORDER BY distance, original_index) AS rank FROM X) WHERE rank <= 3""",
    ),
    "eval_report": sql(
        S, SV, given(C.EVALUATION_QUERIES), GQ, quality_hits("Q"),
        select="""SELECT G.q_id::BIGINT AS q_id, round(coalesce(avg(star), 0), 6) AS popularity,
  count(DISTINCT lang) + coalesce(max((original_index IS NOT NULL AND lang IS NULL)::INT), 0)::BIGINT AS diversity,
  count(original_index) AS total_results FROM G LEFT JOIN RQ USING (q_id) GROUP BY G.q_id""",
    ),
    "eval_report_full": sql(
        S, SV, given(C.EVALUATION_QUERIES), GQ,
        f"VQ AS (SELECT V.* FROM V JOIN S USING (original_index) WHERE len_tokens >= 50 AND star >= 10 AND {COMPLEXITY} <= 8)",
        top("H", "Q", "VQ", 20),
        f"""RQ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY weighted_score, original_index) AS place FROM
  (SELECT q_id, original_index, lang, star, {WEIGHTED} AS weighted_score FROM H JOIN S USING (original_index))) WHERE place <= 10)""",
        select="""SELECT G.q_id::BIGINT AS q_id, round(coalesce(avg(star), 0), 6) AS popularity,
  count(DISTINCT lang) + coalesce(max((original_index IS NOT NULL AND lang IS NULL)::INT), 0)::BIGINT AS diversity,
  count(original_index) AS total_results FROM G LEFT JOIN RQ USING (q_id) GROUP BY G.q_id""",
    ),
    "eval_relevance": sql(
        S, BM, BM25,
        "J AS (SELECT q_id, min(rank) AS first FROM L JOIN S USING (original_index) JOIN BM USING (q_id)\n"
        "  WHERE contains(text, query_text) GROUP BY q_id)",
        select="""SELECT q_id AS item_id, (first IS NOT NULL)::BIGINT AS hit,
  round(coalesce(1.0 / first, 0.0), 6) AS reciprocal_rank FROM BM LEFT JOIN J USING (q_id)""",
    ),
    "eval_recall": sql(
        S, BM, BM25,
        "T AS (SELECT q_id, original_index FROM BM, S WHERE contains(text, query_text))",
        "J AS (SELECT q_id, count(*) AS n_truth, count(rank) AS n_found, min(rank) AS first FROM T LEFT JOIN L USING (q_id, original_index) GROUP BY q_id)",
        select="""SELECT q_id AS item_id, coalesce(n_truth, 0) AS n_truth, coalesce(n_found, 0) AS n_found,
  round(coalesce(n_found / n_truth, 0.0), 6) AS recall, round(coalesce(1.0 / first, 0.0), 6) AS reciprocal_rank FROM BM LEFT JOIN J USING (q_id)""",
    ),
    "popularity_tiers": sql(
        S, SV, given([C.TIER_QUERY]), GQ,
        "T(tier, min_stars) AS (VALUES " + ", ".join(f"({q(t)}, {n})" for t, n in C.POPULARITY_TIERS.items()) + ")",
        f"""X AS (SELECT tier, star, row_number() OVER (PARTITION BY tier ORDER BY {DIST}, original_index) AS rank
  FROM T, Q, V JOIN S USING (original_index) WHERE star >= min_stars)""",
        select=f"""SELECT tier, count(rank) AS result_count, round(coalesce(avg(star), 0), 6) AS avg_repo_popularity
  FROM T LEFT JOIN (SELECT * FROM X WHERE rank <= {C.TIER_K}) USING (tier) GROUP BY tier""",
    ),
    "pattern_coverage": sql(
        S,
        select=" UNION ALL ".join(
            f"SELECT {i}::BIGINT AS case_id, original_index, round(("
            + " + ".join(f"contains(text, {q(p)})::INT" for p in patterns)
            + f") * 10.0 / {len(patterns)}, 6)::DOUBLE AS score FROM S"
            for i, patterns in enumerate({**C.PATTERN_CASES, **C.SNIPPET_CASES}.values())
        ),
    ),
}
